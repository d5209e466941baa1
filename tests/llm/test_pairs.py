"""Near duplicates, repeated passages and fingerprints against plain Python."""

import hashlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from fixtures import (
    awkward,
    clashing,
    components,
    nothing,
    prose,
    rows,
    shingles,
    without_repeats,
    words,
)
from pyspark.sql import functions as F

from uttersieve.llm import bottomk, circulant, repeats
from uttersieve.llm.graph import components as connected


def table(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_near_duplicates(spark, source):
    docs = awkward(spark) if source == "awkward" else spark.read.parquet(f"{DATA}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    label = components({i: t for i, t in texts if i is not None})
    expected = sorted(
        ((i, len(shingles(t)), label.get(i), i is None or label[i] == i) for i, t in texts), key=str
    )
    got = circulant.near_duplicates(clashing(docs))
    assert table(got, "doc_id", "n_shingles", "component_id", "kept") == expected


def test_chain_of_near_copies(spark):
    """Links that no star from the smallest member finds still join."""
    base = prose(9, 60).split()
    versions = []
    for k in range(12):
        w = list(base)
        for j in range(k):
            w[5 * j] = f"new{j}"
        versions.append((100 + k, " ".join(w)))
    # a crowd around the same passage that is not near anything
    versions += [(200 + k, " ".join(base[:34]) + " " + prose(50 + k, 12)) for k in range(40)]
    docs = spark.createDataFrame(versions, "doc_id bigint, text string")
    label = components(dict(versions))
    got = {r["doc_id"]: r["component_id"] for r in circulant.near_duplicates(docs).collect()}
    assert got == label


def test_open_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(circulant, "BLOCK", 3)
    test_chain_of_near_copies(spark)


def test_keep_one(spark):
    docs = clashing(awkward(spark))
    kept = circulant.keep_one(docs)
    assert kept.columns == docs.columns
    label = components({r[0]: r[1] for r in rows() if r[0] is not None})
    expected = sorted([i for i in label if label[i] == i] + [None, None], key=str)
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == expected


def test_signature_estimates():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 2**63, 1000).astype(np.uint64)])
    x, y = circulant.signature(a, 1024), circulant.signature(b, 1024)
    assert abs((x == y).mean() - 0.6) < 0.06
    assert len(set(circulant.band_keys(circulant.signature(a)).tolist())) == circulant.BANDS


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(101, 100), (103, 102), (103, 101), (7, 7)]
    got = connected(spark.createDataFrame(edges, "a bigint, b bigint"))
    label = {r["node"]: r["component_id"] for r in got.collect()}
    assert label == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_repeats(spark, source):
    docs = awkward(spark) if source == "awkward" else spark.read.parquet(f"{DATA}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = repeats.repeated_passages(clashing(docs))
    assert table(got, "doc_id", "n_words", "n_removed", "kept_sha256") == without_repeats(texts)


def test_repeats_in_parts(spark, monkeypatch):
    """Many automata, and shards split into parts."""
    monkeypatch.setattr(repeats, "PHRASES", 3)
    monkeypatch.setattr(repeats, "PASSAGES", 4)
    test_repeats(spark, "awkward")


def test_phrases_of_a_hot_anchor_are_dealt_out(spark, monkeypatch):
    """2,000 phrases of one anchor: no automaton has them all, and passages find theirs."""
    monkeypatch.setattr(repeats, "PHRASES", 400)
    runs = [[f"p{i}x{j}" for j in range(14)] for i in range(2000)]
    phrases = spark.createDataFrame(
        [(7, bytearray(" ".join(w).encode()), i) for i, w in enumerate(runs)]
        + [(8 + i, bytearray(prose(i, 13).encode()), i) for i in range(50)],
        "h bigint, words binary, owner bigint",
    )
    passages = spark.createDataFrame(
        [(7, i, 5000 + i, 0, bytearray(" ".join(["a", *w, "b"]).encode())) for i, w in enumerate(runs)],
        "h bigint, row bigint, doc_id bigint, at int, words binary",
    )
    dealt = repeats._sharded(phrases, phrases, first_only=True)
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert max(sizes) <= 400 and sum(sizes) == 2050
    sent = repeats._sharded(passages, phrases, first_only=False)
    assert sent.groupBy("row").count().agg(F.max("count")).first()[0] <= 4  # windows of a passage
    marks = {r["row"]: r["marks"] for r in repeats._marks(passages, phrases).collect()}
    assert set(marks) == set(range(2000))
    assert all([(m["first"], m["end"]) for m in x] == [(1, 15)] for x in marks.values())


def test_repeats_of_frequent_anchors(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT", 2)
    test_repeats(spark, "awkward")


def test_equal_passages_are_searched_once(monkeypatch):
    """However few are remembered; and many words, past the code points of surrogates."""
    monkeypatch.setattr(repeats, "KNOWN", 1)
    many = [" ".join(f"m{i}x{j}" for j in range(13)).encode() for i in range(5000)]
    automaton = repeats._Automaton([(w, i) for i, w in enumerate(many)])
    searched, machine = [], automaton.machine
    automaton.machine = SimpleNamespace(iter=lambda body: searched.append(body) or machine.iter(body))
    texts = [b"a " + many[4999] + b" b", many[0], b"none of it", many[7] + b" " + many[4600]]
    ids = np.array([6000, 1, 6000, 4000] * 50)
    passage, first, end = automaton.marks(pa.array(texts * 50, pa.binary()), ids)
    assert len(searched) == 4
    found = list(zip(passage.tolist(), first.tolist(), end.tolist()))
    assert found == [
        (4 * i + k, a, b) for i in range(50) for k, a, b in [(0, 1, 14), (1, 0, 13), (3, 0, 13)]
    ]
    ids[:] = 0  # nothing is in a smaller document
    assert [len(x) for x in automaton.marks(pa.array(texts * 50, pa.binary()), ids)] == [0, 0, 0]


def test_texts_without_repeats(spark):
    docs = clashing(awkward(spark)).dropDuplicates(["doc_id", "text"])
    got = repeats.without_repeats(docs)
    assert got.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    digest = lambda t: hashlib.sha256(" ".join(words(t)).encode()).hexdigest()
    assert sorted((str(r["doc_id"]), digest(r["text"])) for r in got.collect()) == sorted(
        (str(i), d) for i, _, _, d in without_repeats(texts)
    )
    bad = got.filter("n_chars <> length(text)").count()
    assert bad == 0


def test_texts_of_repeated_and_conflicting_ids(spark):
    passage, other = prose(1, 40), prose(2, 40)
    texts = [(1, passage), (2, other), (3, f"x {passage}"), (3, f"x {passage}"),
             (3, f"{other} y"), (3, passage), (3, passage), (3, prose(3, 30))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["text"].strip()) for r in repeats.without_repeats(docs).collect())
    assert got == sorted([(1, passage), (2, other), (3, "x"), (3, "x"), (3, "y"), (3, ""), (3, ""),
                          (3, prose(3, 30))])


def test_fingerprints(spark):
    docs = clashing(awkward(spark))
    texts = sorted(
        ((r["doc_id"], r["text"] or "") for r in docs.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0),
    )
    got = bottomk.fingerprints(docs).collect()
    assert len(got) == len(texts)
    after = {}
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][0]  # rows of one id come in any order
        after.setdefault((i, t), set()).update(x for j, x in texts if j == following)
    by_print = {}
    for r in got:
        mine = [t for i, t in texts if i == r["doc_id"] and len(t) == r["n_chars"]]
        possible = set()
        for t in mine:
            q = len(t) // 4
            for n in after[(r["doc_id"], t)] | {x for j, x in texts if r["doc_id"] is None}:
                possible.add(hashlib.sha256((t[: len(t) - q] + n[:q]).encode()).hexdigest())
        assert r["edited_sha256"] in possible
        if len(r["fingerprint"]) < 16 * bottomk.K:  # the whole set
            by_print.setdefault(r["fingerprint"], set()).add(mine[0])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(mine[0].split()) < 64:
            assert len(r["fingerprint"]) == 16 * len(shingles(mine[0], lower=False))
    for same in by_print.values():
        assert len({frozenset(shingles(t, lower=False)) for t in same}) == 1


def test_next_over_many_blocks(spark):
    docs = spark.createDataFrame([(i * i, f"t{i}") for i in range(50)], "doc_id bigint, text string")
    got = bottomk.with_next(docs, block_rows=3).filter("not _guest")
    assert {r["text"]: r["next_text"] for r in got.collect()} == {
        f"t{i}": f"t{(i + 1) % 50}" for i in range(50)
    }


def test_sketches_merge_and_estimate(spark):
    texts = {"a": prose(1, 3000, 10**6), "b": prose(2, 1500, 10**6)}
    texts["c"] = texts["a"] + " " + texts["b"]
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    df = bottomk.with_sketch(df, "text", "s", 256).select("name", "s").cache()
    parts = df.filter("name <> 'c'").withColumn("all", F.lit(1))
    merged = bottomk.merge(parts, ["all"], "s", 256).first()["s"]
    whole = df.filter("name = 'c'").first()["s"]
    # the join of the two texts adds four shingles
    assert len(set(merged) & set(whole)) >= 250
    row = df.filter("name = 'a'").select(F.col("s").alias("a")).crossJoin(
        df.filter("name = 'c'").select(F.col("s").alias("c"))
    ).select(
        bottomk.resemblance("a", "c", 256).alias("r"),
        bottomk.containment("a", "c", 256).alias("k"),
        bottomk.distinct_shingles("c", 256).alias("n"),
    ).first()
    assert abs(row["r"] - 2 / 3) < 0.1 and row["k"] > 0.85 and abs(row["n"] - 4496) < 700
    text = df.select("s", bottomk.from_text(bottomk.as_text("s")).alias("t"))
    assert text.filter("s <> t").count() == 0


def test_empty_tables(spark):
    docs = nothing(spark)
    assert circulant.near_duplicates(docs).count() == 0
    assert circulant.keep_one(docs).count() == 0
    assert repeats.repeated_passages(docs).count() == 0
    assert repeats.without_repeats(docs).count() == 0
    assert bottomk.fingerprints(docs).count() == 0
