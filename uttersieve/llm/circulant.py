"""Near duplicates by circulant MinHash (operator 8).

A document's set holds its distinct 5-word shingles (A-Z lower-cased first).
One permutation scatters the shingles over ``SLOTS`` places; a second one, shifted
round by 0, 1, 2 ... places, gives one minimum for each shift.  Neighbouring
shifts read neighbouring cells of the second permutation, so all coordinates of
a shingle are one contiguous row and a signature is a minimum over rows.

Bands of coordinates propose, full sets decide.  Documents with equal sets become
one representative first, so a crowd of copies weighs as much as one document.
In a bucket every representative is checked against the smallest one (a star, not
all pairs).  Where a star leaves its members in different components, these are
compared in blocks inside tasks, which emit nothing but links.  A pair with the
least similarity, 0.75, shares no band with probability 5e-6.

Nulls and empty texts have an empty set, are linked with nothing and kept.  A
null ``doc_id`` is never linked and always kept, its component is null.  Rows that
share a ``doc_id`` are one document.  Extra columns are not looked at.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps, kernels
from uttersieve.llm.graph import components
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize, small_batches

SLOTS = 1 << 22
BANDS, BAND_ROWS = 32, 4
SHINGLE = 5
BLOCK = 256  # members of one side when a pivot's members are compared
SIMILARITY = 75  # percent
_SPREAD, _OFFSET = 2_654_435_761, 974_711  # the first permutation: i -> i * odd + c
_cells = kernels.kept("cells")


def _rows(coordinates: int, slots: int = SLOTS) -> np.ndarray:
    """Row ``i`` holds the second permutation at ``i, i+1, ...`` (round the end)."""
    key = (coordinates, slots)
    if key not in _cells:
        second = np.random.default_rng(20).permutation(slots).astype(np.int32)
        round_end = np.concatenate([second, second[:coordinates]])
        _cells[key] = np.lib.stride_tricks.sliding_window_view(round_end, coordinates)
    return _cells[key]


def signature(values: np.ndarray, coordinates: int = BANDS * BAND_ROWS) -> np.ndarray:
    """All coordinates of one set of 64-bit hashes."""
    slot = (values >> np.uint64(20)).astype(np.int64) % SLOTS
    slot = (slot * _SPREAD + _OFFSET) % SLOTS
    rows = _rows(coordinates)
    least = np.full(coordinates, SLOTS, np.int32)
    for i in range(0, len(slot), 4096):
        np.minimum(least, rows[slot[i : i + 4096]].min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = sig.reshape(bands, -1).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for column in parts.T:
        key = kernels.mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return kernels.signed(key)


def sketches(docs: DataFrame, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` per row; the text stays behind."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in kernels.chunks(batch.column(1)):
                sets = kernels.shingle_sets(data, offsets, SHINGLE)
                keys = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ]
                bits = [
                    band_keys(signature(s, bands * band_rows), bands) if len(s) else None
                    for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bits, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        kernels.lean(run, "cells"),
        "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"
    )


def _texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``id, body`` of the documents wanted and, by chance, a few more."""
    return bitmaps.sieve(
        docs.filter("doc_id is not null").select(
            F.col("doc_id").alias("id"), F.col("text").alias("body")
        ),
        bitmaps.build(wanted.select(F.xxhash64("id").alias("id")), "id"),
        F.xxhash64("id"),
    )


def _sets(array) -> list:
    """Shingle sets of an Arrow column of texts."""
    out = []
    for _, _, data, offsets in kernels.chunks(array):
        out += kernels.shingle_sets(data, offsets, SHINGLE)
    return out


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``a, b, both, either``: exact sizes of intersection and union of each pair.

    Whole texts travel, they are shorter than their sets; a bitmap of fixed size holds
    back those that no pair asks for.  The pairs are few per document, and a pivot
    that many pairs share is one row on its side.
    """
    wanted = pairs.select(F.col("a").alias("id")).unionByName(
        pairs.select(F.col("b").alias("id"))
    )
    texts = _texts(wanted, docs)
    left = texts.select(F.col("id").alias("a"), F.col("body").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("body").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                left, right = _sets(part.column(2)), _sets(part.column(3))
                both = [
                    len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)
                ]
                either = [len(x) + len(y) - n for x, y, n in zip(left, right, both)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(both, pa.int64()),
                     pa.array(either, pa.int64())],
                    names=["a", "b", "both", "either"],
                )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        kernels.lean(run), "a bigint, b bigint, both bigint, either bigint"
    )


def _linked(checked: DataFrame, similarity: int) -> DataFrame:
    return checked.filter(
        (F.col("either") > 0) & (F.col("both") * 100 >= F.col("either") * similarity)
    )


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    sketch = materialize(sketches(docs), "sketches")
    known = sketch.filter("doc_id is not null and set_key is not null")
    nodes = materialize(known.groupBy("set_key").agg(F.min("doc_id").alias("node")), "nodes")
    banded = (
        known.join(nodes.select("set_key", F.col("node").alias("doc_id")), ["set_key", "doc_id"],
                   "left_semi")
        .select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    )
    # buckets with more than one member; of buckets with the same members one is enough
    tag = F.xxhash64(F.lit(7), "node")
    buckets = (
        banded.groupBy("key")
        .agg(
            F.min("node").alias("pivot"),
            F.max("node").alias("last"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("m1"),
            F.sum(tag.cast("decimal(20,0)")).alias("m2"),
        )
        .filter("pivot < last")
        .groupBy("pivot", "last", "n", "m1", "m2")
        .agg(F.min("key").alias("key"))
        .select("key", "pivot")
    )
    buckets = materialize(buckets, "buckets")
    sieved = bitmaps.sieve(banded, bitmaps.build(buckets, "key"), F.col("key"))
    members = materialize(
        sieved.join(buckets, "key").select("node", "pivot").distinct(), "members"
    )

    stars = members.filter("node <> pivot").select(
        F.col("node").alias("a"), F.col("pivot").alias("b")
    )
    links = materialize(_linked(_verify(stars, docs), similarity).select("a", "b"), "linked")
    parts = materialize(components(links), "parts")
    more = materialize(_open_links(members, parts, docs, similarity), "open")
    if more.limit(1).count():
        parts = materialize(components(links.unionByName(more)), "parts")

    named = nodes.join(parts, "node", "left").select(
        "set_key", F.coalesce("component_id", "node").alias("_c")
    )
    # ids that share a set are one node; an id with several sets joins their components
    return (
        sketch.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _open_links(members, parts, docs, similarity) -> DataFrame:
    """Links ``a, b`` between members that share a pivot and are in different components.

    A pivot's members are dealt into blocks of about ``BLOCK`` and every two blocks are
    compared in one task, exactly and without emitting pairs: a task returns links only.
    """
    placed = members.join(parts, "node", "left").select(
        "pivot", "node", F.coalesce("component_id", "node").alias("part")
    )
    split = (
        placed.groupBy("pivot")
        .agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("n"))
        .filter("p <> q")
        .select("pivot", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    placed = placed.join(split, "pivot").withColumn(
        "_mine", F.pmod(F.xxhash64("node"), F.col("blocks"))
    )
    cells = materialize(
        placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "pivot",
            "node",
            "part",
            F.least("_mine", "_other").alias("i"),
            F.greatest("_mine", "_other").alias("j"),
            (F.col("_mine") <= F.col("_other")).alias("left"),
            (F.col("_mine") >= F.col("_other")).alias("right"),
        ),
        "cells",
    )
    wanted = cells.select(F.col("node").alias("id")).distinct()
    texts = _texts(wanted, docs).select(F.col("id").alias("node"), F.col("body").alias("text"))

    def compare(table):
        found_a, found_b = [], []
        names = ("node", "part", "left", "right")
        node, part, left, right = (table.column(n).to_numpy() for n in names)
        sets = _sets(table.column("text").combine_chunks())
        size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        mine = right[owner]  # the side that is looked up
        there, there_owner = values[mine], owner[mine]
        for x in np.flatnonzero(left):
            lo = np.searchsorted(there, sets[x], "left")
            n = np.searchsorted(there, sets[x], "right") - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(there_owner[at], minlength=len(sets))
            hit = (
                (common > 0) & (part != part[x])
                & (common * 100 >= (size + size[x] - common) * similarity)
            )
            found_a += [int(node[x])] * int(hit.sum())
            found_b += node[hit].tolist()
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return (
        cells.join(texts, "node")
        .groupBy("pivot", "i", "j")
        .applyInArrow(compare, "a bigint, b bigint")
        .distinct()
    )


@query("op8_near_duplicates")
def op8(spark, folder):
    """Component and verdict of every document."""
    return near_duplicates(documents(spark, folder))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, unchanged; the smallest id stays.

    Of rows that share the id one stays; rows without an id stay.
    """
    name = bitmaps.fresh(docs, "dropped")
    special = (
        near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id")
        .agg((~F.max("kept")).alias(name), F.count("*").alias("n"))
        .filter(F.col(name) | (F.col("n") > 1))
        .drop("n")
    )
    rest, hit = bitmaps.meet(docs, materialize(special, "special"))
    hit = hit.filter(~F.coalesce(F.col(name), F.lit(False)))
    once = hit.filter(F.col(name).isNull()).drop(name)
    more = hit.filter(F.col(name).isNotNull()).drop(name).dropDuplicates(["doc_id"])
    return rest.unionByName(once).unionByName(more)
