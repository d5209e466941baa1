"""Session defaults and the shared scratch folder."""

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # streams keep ids as state: on disk, not in the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set = set()  # applications whose workers have the package


def build_session(master=None, app="uttersieve", **extra):
    """A session with the settings the package is tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only on a ``local`` master is a temporary folder made where none is named, and
    remembered in the session so that one run uses one folder.  Elsewhere every machine
    has its own disk, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("uttersieve.scratch", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="uttersieve-")
        spark.conf.set("uttersieve.scratch", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder; nothing is created."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage like a reliable checkpoint, but columnar, so later reads
    prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Hand Python workers a few megabytes of rows at a time, unless the session says how much.

    Spark fills a batch up to 64 MB, and holds it several times over outside the heap
    (vectors and buffers grow by doubling) for every task; the allocator keeps that.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, size)


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    The same as ``--py-files``, for sessions that were started without it.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="uttersieve-")) / f"package-{uuid.uuid4().hex}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(root.rglob("*.py")):
                z.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
