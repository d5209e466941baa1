"""Whole jobs: curate a corpus, export the matches, extract features."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttersieve.functions import audio
from uttersieve.functions.text import language, model_for
from uttersieve.operators import infer, packing, scoring
from uttersieve.operators.order import BLOCK_ROWS
from uttersieve.schema import FOLDER_LIMIT
from uttersieve.session import materialize, ship_package
from uttersieve.sinks import tables as sinks
from uttersieve.sinks.archives import write_archives
from uttersieve.sources import files, tables
from uttersieve.streaming import curation


def curate(
    spark: SparkSession,
    corpus: str,
    out: str,
    factory,
    subsets=None,
    stream=True,
    engine="pipeline",
    attempts=5,
    files_per_batch=1000,
    spread=None,
) -> DataFrame:
    """Transcribe, score and log a corpus; returns the summary per subset.

    Streaming and batch runs may follow each other in any order: a stream goes
    on from its checkpoint, and each leaves out what the other has done.  Both
    commit every ``files_per_batch`` files and try a group ``attempts`` times, so a
    failure repeats one group at most.
    :func:`results` reads the log, with a clip only for matches.
    """
    ship_package(spark)
    mine, other = (f"{out}/{n}" for n in (("stream", "batch") if stream else ("batch", "stream")))

    def heard(todo):
        return _logged(
            curation.observed(curation.score_stream(todo, factory, engine=engine, spread=spread))
        )

    done = tables.reopen(spark, other, _RESULTS)
    if stream:
        todo = tables.utterance_stream(spark, corpus, subsets, files_per_batch=files_per_batch)
        rows = heard(curation.remaining(todo, done.select("subset", "seq")))
        # the sink's own log decides which files count, so its folder is its own
        curation.run_to_end(
            lambda: curation.append_query(rows, mine, f"{out}/_checkpoint"), attempts
        )
    else:
        index = None
        for group in tables.utterance_groups(spark, corpus, subsets, files_per_batch):

            def write(group=group):
                nonlocal index
                if index is None:  # at first, and after a failure, which may have left rows
                    log = done.unionByName(tables.reopen(spark, mine, _RESULTS))
                    index = curation.Done(log.select("subset", "seq"))
                now, index = index, None
                heard(now.without(group)).write.mode("append").partitionBy("subset").parquet(mine)
                now.add(group.select("subset", "seq"))
                index = now

            curation.run_again(write, attempts)
    everything = results(spark, out)
    totals = scoring.summary(scoring.accuracy(everything))
    hits = everything.filter("acc = 1").select("subset", "seq", "utt_id")
    sinks.write_results(hits, totals, f"{out}/ids")
    return totals


def results(spark: SparkSession, out: str) -> DataFrame:
    """Every row a curation run has processed."""
    stream, batch = (tables.reopen(spark, f"{out}/{n}", _RESULTS) for n in ("stream", "batch"))
    return stream.unionByName(batch)


_RESULTS = (
    "seq bigint, id string, utt_id string, text string, hypothesis string, error string, "
    "acc int, clip binary, subset string"
)


def _logged(rows: DataFrame) -> DataFrame:
    """What is kept of a scored row; only a match keeps its clip, encoded."""
    samples, rate = F.col("audio.array"), F.col("audio.sampling_rate")
    clip = audio.encode_wav(F.when(F.col("acc") == 1, samples), rate)
    return rows.withColumn("clip", clip).select(
        "seq", "id", "utt_id", "text", "hypothesis", "error", "acc", "clip", "subset"
    )


def export_clips(
    clips: DataFrame, path: str, limit=FOLDER_LIMIT, block_rows=BLOCK_ROWS, partitions=None
) -> None:
    """Pack ``subset, seq, utt_id, text, samples, rate`` into folders and write one
    archive per folder.

    The folders come from the sizes alone.  Their ranges are written down first:
    a few rows per block with a known size, so the clips find their folder
    without a shuffle, and are shuffled once, to their archives.
    """
    sized = clips.withColumn("size", audio.wav_size("samples"))
    ranges = materialize(
        packing.folder_ranges(sized, limit=limit, block_rows=block_rows), "folders"
    )
    placed = packing.assign_folders(clips, ranges, block_rows=block_rows)
    clip = audio.encode_wav("samples", "rate")
    width = partitions or archive_tasks(clips.sparkSession, ranges, limit)
    write_archives(placed.withColumn("clip", clip), path, width)


def archive_tasks(spark: SparkSession, ranges: DataFrame, limit: int) -> int:
    """Tasks to write the archives with: about one folder's bytes each, at least as many
    as any shuffle has.  The ranges are written down, so this is a sum of short rows."""
    total = ranges.agg(F.sum("bytes")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // limit))


def export_matched(
    spark: SparkSession, out: str, path: str, limit=FOLDER_LIMIT, partitions=None
) -> None:
    """Export the matches of a curation run, whose clips are encoded already."""
    ship_package(spark)
    hits = results(spark, out).filter("acc = 1")
    sized = hits.select("subset", "seq", F.octet_length("clip").cast("bigint").alias("size"))
    ranges = materialize(packing.folder_ranges(sized, limit=limit), "folders")
    placed = packing.assign_folders(hits.select("subset", "seq", "utt_id", "text", "clip"), ranges)
    write_archives(placed, path, partitions or archive_tasks(spark, ranges, limit))


def extract_features(
    spark: SparkSession, root: str, out: str, factory, symbol=None, model="encoder"
) -> DataFrame:
    """Features of all WAV files below ``root`` that have none yet, by path.

    What is done is found from paths alone; each task then opens its files, so audio
    is never shuffled.  A file that cannot be decoded or encoded has an ``error`` and
    no features, and the next run takes it again; :func:`features_of` reads the rest.
    """
    ship_package(spark)
    paths = files.wav_files(spark, root, symbol).select("path", "length", "speaker", "name")
    done = features_of(spark, out).select("path")
    todo = paths.join(done, "path", "left_anti")
    decoded = files.decoded_wavs(todo, length="length").select(
        "path", "speaker", "name", "samples", "rate", F.col("error").alias("unread"),
        F.lit(model).alias("model_id"), F.lit(None).cast("string").alias("language"),
    )
    kept = audio.keep_frames("features", audio.frame_count("samples", "rate"))
    rows = infer.features(decoded, factory, audio="samples").withColumns(
        {
            "error": F.coalesce("unread", "error"),
            "features": F.when(F.col("unread").isNull() & F.col("error").isNull(), kept),
        }
    )
    sinks.write_features(rows, out)
    return features_of(spark, out)


def features_of(spark: SparkSession, out: str) -> DataFrame:
    """The features a run has written: ``path, name, features, speaker``."""
    return tables.reopen(spark, out, _FEATURES).filter("error is null").drop("error")


_FEATURES = "path string, name string, features array<array<float>>, error string, speaker string"


def with_model(rows: DataFrame, engine="pipeline") -> DataFrame:
    """Language and model columns from the subset."""
    return rows.withColumns(
        {"language": language("subset"), "model_id": model_for("subset", engine)}
    )
