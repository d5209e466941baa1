"""The queries of this subpackage and their SQL twins."""

from uttersieve.session import ship_package

QUERIES: dict = {}
TWINS: dict = {}


def query(name, sql=None):
    """Register ``(spark, folder) -> DataFrame``."""

    def add(fn):
        def run(spark, folder):
            return fn(ship_package(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return fn

    return add


def documents(spark, folder):
    """The table all operators work on."""
    return spark.read.parquet(f"{folder}/documents.parquet")


def discard(table):
    """Delete a scratch table that nothing will read again, to give its disk back."""
    files = table.inputFiles()
    if files:
        jvm = table.sparkSession.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        conf = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)


def load():
    """Import the modules that register queries."""
    from uttersieve.llm import (  # noqa: F401
        audit,
        bottomk,
        circulant,
        hdlang,
        histsort,
        hostrules,
        periods,
        pieces,
        pigeonring,
        pii,
        powerpack,
        repeats,
        toxicity,
    )

    return QUERIES, TWINS
