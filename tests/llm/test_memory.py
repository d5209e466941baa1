"""What Python workers are given at a time, and what they keep between tasks."""

import pyarrow as pa
import pytest
from fixtures import awkward
from pyspark import cloudpickle
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps, circulant, kernels, pii, powerpack, repeats
from uttersieve.session import BATCH_BYTES


def sent(run, *keeps):
    """The task as a worker gets it."""
    return cloudpickle.loads(cloudpickle.dumps(kernels.lean(run, *keeps)))


def test_tables_go_with_the_task():
    def run(batches):
        kernels._powers(10)
        yield len(kernels._tables)

    assert list(sent(run)([])) == [1]
    assert not kernels._tables


def test_kept_only_for_tasks_of_the_same_kind():
    for cache, name, other in (
        (circulant._cells, "cells", "words"), (powerpack._loaded, "words", "cells")
    ):
        cache.clear()
        cache["x"] = 1
        assert list(sent(iter, name)([1])) == [1]
        assert cache == {"x": 1}
        list(sent(iter, other)([]))
        assert cache == {}
        cache["x"] = 1
        list(sent(iter)([]))
        assert cache == {}


def test_vocabulary_is_loaded_once_for_pieces():
    path = powerpack.vocabulary()

    def run(batches):
        for texts in batches:
            yield list(powerpack.token_bytes(texts, path))

    task = sent(run, "words")
    first = list(task([["one two"]]))
    loaded = powerpack._loaded[path]
    assert list(task([["one two"]])) == first
    assert powerpack._loaded[path] is loaded
    powerpack._loaded.clear()


@pytest.fixture
def unset(spark):
    spark.conf.unset(BATCH_BYTES)
    yield spark
    spark.conf.unset(BATCH_BYTES)


@pytest.mark.parametrize("operator", [
    circulant.sketches,
    repeats.anchors,
    pii.found,
    lambda docs: powerpack.pieces(docs, powerpack.vocabulary()),
    lambda docs: bitmaps.sieve(docs, None, F.xxhash64("doc_id")),
])
def test_batches_are_small(unset, operator):
    operator(awkward(unset))
    many = unset.range(24).select(F.expr("repeat('abcdefgh ', 120000)").alias("text")).coalesce(1)

    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    got = many.mapInArrow(size, "n bigint, bytes bigint").collect()
    assert sum(r["n"] for r in got) == 24
    assert max(r["bytes"] for r in got) < 6 << 20


def test_a_chosen_size_stays(unset):
    unset.conf.set(BATCH_BYTES, "9m")
    pii.found(awkward(unset))
    assert unset.conf.get(BATCH_BYTES) == "9m"


def test_small_batches_change_no_sketch(unset):
    docs = awkward(unset)
    unset.conf.set(BATCH_BYTES, "1k")
    few = sorted(map(str, circulant.sketches(docs).collect()))
    unset.conf.set(BATCH_BYTES, "64m")
    assert sorted(map(str, circulant.sketches(docs).collect())) == few
