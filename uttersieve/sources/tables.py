"""Corpus tables, in batch or as a stream, match logs and in-memory rows."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uttersieve.operators.order import chunk_number, positions
from uttersieve.schema import CHUNK_ROWS, UTTERANCE
from uttersieve.session import materialize


PLACE_ROWS = 4_000_000  # positions sent to every task at once: 8 bytes a row, 32 MB
_PLACES = 4096  # positions of one row of their table


def numbered(df: DataFrame, seq="seq") -> DataFrame:
    """``df``, failing where a row without ``seq`` is met.

    What is done is kept by ``seq``, so such rows would be done again by every run.  A
    schema that has no such column is another table's.
    """
    if seq not in df.columns:
        return df
    missing = F.raise_error(F.lit(f"a row without {seq}: ingest the corpus first"))
    return df.withColumn(seq, F.coalesce(F.col(seq), missing.cast("bigint")))


def utterances(spark: SparkSession, root: str, subsets=None, schema=UTTERANCE) -> DataFrame:
    """A corpus laid out by ``subset``; a list of subsets reads only their folders."""
    df = spark.read.schema(schema).parquet(root)
    return df if subsets is None else df.filter(F.col("subset").isin(*subsets))


def utterance_groups(
    spark: SparkSession, root: str, subsets=None, files_per_group=1000, schema=UTTERANCE
):
    """The corpus in groups of files, in order of their names: one DataFrame each.  A row
    without ``seq`` is an error."""
    names = sorted(utterances(spark, root, subsets, schema).inputFiles())
    for i in range(0, len(names), files_per_group):
        reader = spark.read.schema(schema).option("basePath", root)
        df = numbered(reader.parquet(*names[i : i + files_per_group]))
        yield df if subsets is None else df.filter(F.col("subset").isin(*subsets))


def ingest(spark: SparkSession, raw: str, out: str, subset="subset") -> DataFrame:
    """Copy a raw corpus to ``out`` with ``seq``: dense from 0 per subset, in the order of
    file names and of rows within a file, however subsets and files cross.

    A position is the rows of the subset in earlier files, plus the rank among the
    file's rows of the subset.  The first is a running sum over short rows, one per file and
    subset.  In a file of one subset the second is the row's place, which the scan
    knows.  Of mixed files it is counted over ``(file, subset, place)`` alone, in blocks, and
    written down as arrays of ``_PLACES`` positions.

    So audio is read once, numbered where it is read, and written: files are taken in runs of
    at most ``PLACE_ROWS`` rows in mixed files (one larger file is a run of its own), whose
    arrays are sent to every task.  A corpus of unmixed files is one run.  A row without a
    subset is refused before anything is written.  An ingest that fails between two
    runs leaves ``out`` incomplete, and the next one refuses to write there.
    """
    place = F.col("_metadata.row_index")
    rows = spark.read.option("basePath", raw).parquet(raw).select(
        "*", F.col("_metadata.file_path").alias("_file"), place.alias("_row")
    ).drop("seq")
    counts = materialize(
        rows.groupBy("_file", F.col(subset).alias("_s")).agg(F.count(F.lit(1)).alias("_n")), "files"
    )
    if counts.filter("_s is null").limit(1).count():
        raise ValueError("a row without a subset")
    earlier = Window.partitionBy("_s").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    offsets = materialize(
        counts.select(
            "_file", "_s", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            (F.count(F.lit(1)).over(whole) > 1).alias("_mixed"), F.sum("_n").over(whole).alias("_all"),
        ),
        "offsets",
    )
    pure = offsets.filter("not _mixed").select("_file", "_before")
    mixed = offsets.filter("_mixed")
    sizes = mixed.select("_file", "_all").distinct().orderBy("_file").collect()  # a name per file
    if not sizes:
        found = rows.join(pure, "_file").withColumn("seq", F.col("_before") + F.col("_row"))
        found.drop("_file", "_row", "_before").write.partitionBy(subset).parquet(out)
        return spark.read.parquet(out)

    narrow = rows.select("_file", "_row", F.col(subset).alias("_s")).join(
        mixed.select("_file", "_s", "_before"), ["_file", "_s"]
    )
    ranked = positions(narrow, ["_file", "_s"], "_row", "_rank").select(
        "_file", "_row", (F.col("_before") + F.col("_rank") - 1).alias("seq")
    )
    places = materialize(
        ranked.groupBy("_file", F.expr(f"_row div {_PLACES}").alias("_block"))
        .agg(F.array_sort(F.collect_list(F.struct("_row", "seq"))).alias("_at"))
        .select("_file", "_block", F.col("_at.seq").alias("_seqs")),
        "places",
    )
    for n, (low, high) in enumerate(_runs(sizes)):
        here = F.lit(True) if low is None else F.col("_file") > low
        here = here if high is None else here & (F.col("_file") <= high)
        found = (
            rows.filter(here)
            .withColumn("_block", F.expr(f"_row div {_PLACES}"))
            .join(F.broadcast(places.filter(here)), ["_file", "_block"], "left")
            .join(pure, "_file", "left")
            .withColumn(
                "seq",
                F.coalesce(
                    F.expr(f"get(_seqs, cast(_row % {_PLACES} as int))"),
                    F.col("_before") + F.col("_row"),
                ),
            )
            .drop("_file", "_row", "_block", "_seqs", "_before")
        )
        found.write.mode("append" if n else "errorifexists").partitionBy(subset).parquet(out)
    return spark.read.parquet(out)


def _runs(sizes):
    """Bounds ``(after, upto)`` between file names, ``PLACE_ROWS`` rows of mixed files each."""
    low, rows, last = None, 0, None
    for name, n in sizes:
        if rows and rows + n > PLACE_ROWS:
            yield low, last
            low, rows = last, 0
        rows, last = rows + n, name
    yield low, None


def utterance_stream(
    spark: SparkSession, root: str, subsets=None, schema=UTTERANCE, files_per_batch=None, glob=None
) -> DataFrame:
    """The same as a stream of files; its position is the query's checkpoint.  A row
    without ``seq`` ends it."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = numbered(reader.parquet(root))
    return df if subsets is None else df.filter(F.col("subset").isin(*subsets))


def reopen(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A table saved before; a missing one is empty if its schema is given."""
    if schema is None:
        return spark.read.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def log_chunks(log: DataFrame, keys=("subset",), seq="seq", chunk_rows=CHUNK_ROWS) -> DataFrame:
    """The match log with the number of its fixed-size chunk per subset."""
    return positions(log, keys, seq, "_at").select(
        *log.columns, chunk_number("_at", chunk_rows).alias("chunk")
    )


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A DataFrame of rows held in memory."""
    return spark.createDataFrame(rows, schema)
