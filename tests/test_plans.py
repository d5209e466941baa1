"""Physical plans: what must hold at any size of the data."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
from uttersieve.operators import order, packing, scoring, selecting
from uttersieve.plans import views
from uttersieve.schema import UTTERANCE
from uttersieve.sources import tables

# queries that return a table they have written: the plan shows its scan only
QUERIES = entry.queries()
LAZY = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


@pytest.fixture
def no_broadcast(spark):
    """Sizes as at scale: nothing is below the broadcast threshold."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, no_broadcast, name):
    text = physical(QUERIES[name](spark, DATA))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in text


def test_flagship_shuffles_and_columns(spark, no_broadcast):
    text = physical(QUERIES["accuracy_by_subset"](spark, DATA))
    assert text.count("Exchange") == 3  # two sides of the pairing, one small aggregate
    assert "partial_sum" in text and "n_chars" not in text


def test_resume_is_pushed_to_the_scan(spark):
    text = physical(selecting.from_index(views.utt(spark, DATA), 150))
    assert "GreaterThanOrEqual(doc_id,150)" in text


def test_subsets_are_pruned_and_audio_is_not_read(spark, tmp_path):
    path = str(tmp_path / "corpus")
    rows = [(s, 0, "0", f"{s}-0", (None, [0.0], 16), "x") for s in ("en100", "es000")]
    spark.createDataFrame(rows, UTTERANCE).write.partitionBy("subset").parquet(path)
    df = tables.utterances(spark, path, ["en100"]).select("subset", "utt_id", "audio.sampling_rate")
    text = physical(df)
    assert "PartitionFilters: [" in text and "subset" in text.split("PartitionFilters: [")[1][:80]
    assert "audio:struct<sampling_rate:int>" in text and "array" not in text.split("ReadSchema")[1]
    assert df.count() == 1


def test_top_k_is_limited_before_the_shuffle(spark):
    text = physical(QUERIES["channel_search"](spark, DATA))
    assert text.index("WindowGroupLimit") and "Partial" in text


def test_windows_run_per_block(spark):
    subset = (F.col("id") % 2).cast("string").alias("subset")
    rows = spark.range(10).select(subset, F.col("id").alias("seq"), F.lit(1).alias("acc"))
    for df in (scoring.running_accuracy(rows), order.positions(rows, ["subset"], "seq")):
        text = physical(df)
        # the rows themselves: one shuffle, by block
        wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert "_block" in wide[0]
        assert "SinglePartition" not in text


def test_folders_need_no_shuffle_of_the_clips(spark, tmp_path):
    clips = spark.range(100).select(
        (F.col("id") % 2).cast("string").alias("subset"), F.col("id").alias("seq"),
        F.lit(10).alias("size"), F.hex("id").alias("payload"),
    )
    ranges = packing.folder_ranges(clips, limit=50)
    assert "payload" not in physical(ranges)
    ranges.write.parquet(str(tmp_path / "r"))
    text = physical(packing.assign_folders(clips, spark.read.parquet(str(tmp_path / "r"))))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
