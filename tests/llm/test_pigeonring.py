"""SimHash near duplicates against all pairs of fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import DATA
from fixtures import LOWER, awkward, clashing, nothing, prose, rows
from pyspark.sql import functions as F

from uttersieve.llm import graph, pigeonring
from uttersieve.llm.registry import QUERIES, documents


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42)
              for i in range(max(1, len(w) - 3))]
    bits = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))
    return bits - (bits >> 63 << 64)


def slow_components(prints):
    """``id -> smallest reachable id`` for ``{id: fingerprint}``."""
    ids = sorted(prints)
    fp = np.array([prints[i] for i in ids], np.int64).view(np.uint64)
    least = dict(zip(ids, ids))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(fp[k + 1 :] ^ fp[k]) <= 4):
            a, b = sorted((find(i), find(ids[k + 1 + j])))
            least[b] = a
    return {i: find(i) for i in ids}


def crowd(n, flips, centers=12, seed=1):
    """Fingerprints about a few centers, up to ``flips`` bits away."""
    rng, out = random.Random(seed), {}
    middle = [rng.getrandbits(64) for _ in range(centers)]
    for i in range(n):
        f = rng.choice(middle)
        for _ in range(rng.randrange(flips + 1)):
            f ^= 1 << rng.randrange(64)
        out[100 + i] = f - (f >> 63 << 64)
    return out


def components_of(spark, prints):
    first = {}
    for i, f in sorted(prints.items()):
        first.setdefault(f, i)
    nodes = spark.createDataFrame(list(first.items()), "fp bigint, id bigint")
    found = pigeonring.links(nodes).collect()
    least = dict(zip(prints, prints))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for r in found:
        assert first[r["a_fp"]] == r["a_id"] and (r["a_fp"] ^ r["b_fp"]) & (2**64 - 1)
        a, b = sorted((find(r["a_id"]), find(r["b_id"])))
        least[b] = a
    return {i: find(first[f]) for i, f in prints.items()}


def test_fingerprints():
    texts = [r[1] for r in rows()] + ["A b C", "a B c", "x " * 70_000, prose(9, 9000)]
    for t in texts:
        assert pigeonring.fingerprint((t or "").encode()) == slow_fingerprint(t)
    assert pigeonring.fingerprint(b"A b C") == pigeonring.fingerprint(b"a\tb \nc")


@pytest.mark.parametrize(
    "most, block, flips", [(8192, 4096, 9), (60, 30, 9), (9, 4, 9), (2, 2, 4)]
)
def test_links_of_crowds(spark, monkeypatch, most, block, flips):
    monkeypatch.setattr(pigeonring, "MOST", most)
    monkeypatch.setattr(pigeonring, "BLOCK", block)
    prints = crowd(500, flips)
    assert components_of(spark, prints) == slow_components(prints)


def test_every_pair_meets_in_one_chain_of_keys():
    """Of any two fingerprints at the distance, one visits a key the other is at home under."""
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(1, 5)):
            b ^= 1 << bit
        chains = pigeonring._chains(4)
        fits = [
            s for s in range(5)
            if all(((a ^ b) & int(chains[s, n - 1])).bit_count() <= n * 4 // 5 for n in range(1, 6))
        ]
        assert fits
        both = np.array([a, b], np.uint64)
        for s in fits:
            one, two = pigeonring._keys(both, s, 1, 4)
            assert one == two


def test_flips():
    masks = pigeonring._flips(13, 13, 2)
    assert len(masks) == len(set(masks)) == 1 + 13 + 78
    assert all(m.bit_count() <= 2 and m >> 13 << 13 == m and m < 1 << 26 for m in masks)


def test_forest_within_buckets():
    key = np.full(6, 1 << pigeonring.KEY_BITS)  # chains from the second segment on
    fp = np.array([0, 1, 3, 2**60 - 1, 2**60, 2**60 + 1], np.uint64)
    part = np.array([1, 1, 1, 1, 2, 2])
    i, j = pigeonring._linked(key, fp, part, 4)
    assert dict(zip(i.tolist(), j.tolist())) == {1: 0, 2: 0, 5: 4}


def expected(pairs):
    prints = [(i, slow_fingerprint(t)) for i, t in pairs]
    least = {}
    for i, f in prints:
        if i is not None:
            least[f] = min(least.get(f, i), i)
    root = slow_components({i: f for f, i in least.items()}) if len(
        set(least.values())) == len(least) else None
    return [(i, f, root[least[f]] if i is not None else None) for i, f in prints]


@pytest.mark.parametrize("table", ["awkward", "given"])
def test_near_duplicates(spark, table):
    docs = awkward(spark) if table == "awkward" else documents(spark, DATA)
    got = pigeonring.near_duplicates(clashing(docs)).select("doc_id", "fp", "component_id")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_query_writes_digits(spark):
    got = {r["doc_id"]: r for r in QUERIES["op13_pigeonring"](spark, DATA).collect()}
    for r in documents(spark, DATA).collect():
        assert int(got[r["doc_id"]]["fingerprint"], 16) == slow_fingerprint(r["text"]) % 2**64
        assert len(got[r["doc_id"]]["fingerprint"]) == 16


def test_an_id_with_two_texts(spark):
    texts = [(1, prose(1, 40)), (2, prose(1, 40)), (2, prose(2, 40)), (3, prose(2, 40))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = pigeonring.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (2, 2), (3, 2)]


def test_keep_one(spark):
    docs = clashing(awkward(spark))
    kept = pigeonring.keep_one(docs)
    assert kept.schema == docs.schema
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 11 not in ids and 17 not in ids and 10 in ids and ids.count(None) == 2


def test_look_up_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT_ROWS", 5)
    rows_ = spark.range(100).select(F.when(F.col("id") < 60, 1).otherwise(F.col("id")).alias("k"))
    table = rows_.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    got = graph.look_up(rows_, table.filter("k <> 99"), "k", "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 2)] * 60 + [(k, 2 * k if k < 99 else None) for k in range(60, 100)], key=str)


def test_nothing(spark):
    assert pigeonring.near_duplicates(nothing(spark)).count() == 0
    assert pigeonring.keep_one(nothing(spark)).count() == 0
