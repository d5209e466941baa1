"""Periodic runs against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from fixtures import awkward, clashing, nothing, prose, words

from uttersieve.llm import kernels, periods
from uttersieve.llm.registry import QUERIES, documents


def slow_runs(w):
    """All runs, by trying every period at every word."""
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            stretch = w[i : i + length]
            if length >= max(24, 3 * q) and not any(
                stretch[r:] == stretch[:-r] for r in range(1, q)
            ):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def expected(doc_id, text):
    w = planted(doc_id, text)
    found = slow_runs(w)
    best = (None,) * 4
    for s, n, q in found:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(w, found))]
    return (doc_id, len(found), *best, *digests)


def stretches(seed):
    """A text of stretches over few words, some of them periodic."""
    rng, out = random.Random(seed), []
    for _ in range(rng.randrange(7)):
        part = [rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(rng.randrange(1, 40))]
        out += (part * rng.randrange(1, 12))[: rng.randrange(1, 150)]
    return " ".join(out)


def test_runs_of_many_texts():
    texts = [stretches(i) for i in range(250)]
    texts += ["", None, "a " * 400, "é 日本 " * 30, "a b " * 11 + "a", "a b " * 12, "x " * 23, "x " * 24]
    for lo, hi, data, offsets in kernels.chunks(pa.array(texts), 10_000):
        w, found, kept = periods._measured(data, offsets)
        for d in range(lo, hi):
            a, b = w.first[d - lo], w.first[d - lo + 1]
            own = found[(found[:, 0] >= a) & (found[:, 0] < b)] - [a, 0, 0]
            plain = words(texts[d])
            assert list(map(tuple, own.tolist())) == slow_runs(plain)
            assert kept[d - lo].as_py() == collapsed(plain, slow_runs(plain))


def test_fibonacci_word_and_neighbouring_runs():
    a, b = "a", "ab"
    while len(b) < 300:
        a, b = b, b + a
    both = ["u v w " * 10 + "x y z " * 10, "a b " * 13 + "a c " * 13, " ".join(b)]
    for text in both:
        array = pa.array([text])
        (_, _, data, offsets), = kernels.chunks(array)
        found = periods._measured(data, offsets)[1]
        assert list(map(tuple, found.tolist())) == slow_runs(text.split())


def test_long_run_of_one_document():
    n = 40_000
    code = np.arange(n) % 1000
    code[-1] = 5000
    assert periods.runs(code, np.array([0, n])).tolist() == [[0, n - 1, 1000]]


@pytest.mark.parametrize("table", ["awkward", "given"])
def test_op11(spark, table):
    docs = awkward(spark) if table == "awkward" else documents(spark, DATA)
    docs = docs.unionByName(
        spark.createDataFrame(
            [(5000 + i, stretches(i)) for i in range(40)], "doc_id bigint, text string"
        ),
        allowMissingColumns=True,
    )
    got = periods.digest(periods.repeated_runs(periods.with_planted(clashing(docs))))
    want = [expected(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 5


def test_query_is_registered(spark):
    assert QUERIES["op11_basic_factors"](spark, DATA).count() == documents(spark, DATA).count()


def test_collapsed_rows_keep_their_columns(spark):
    docs = clashing(awkward(spark))
    out = periods.collapsed(docs)
    assert out.schema == docs.schema
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    after = {(r["doc_id"], r["text"]) for r in out.collect()}
    changed = {i for i, _ in after - before}
    assert changed == {i for i, t in before if slow_runs(words(t))}
    assert (25, "again and we say it so") not in after and out.count() == docs.count()
    twice = periods.collapsed(out).select("doc_id", "text").collect()
    assert {tuple(r) for r in twice} == after


def test_nothing(spark):
    assert periods.repeated_runs(nothing(spark)).count() == 0
    assert periods.collapsed(nothing(spark)).count() == 0


def test_numbers_of_words():
    text = prose(3, 200, 20) + " \t " + "é É é"
    (_, _, data, offsets), = kernels.chunks(pa.array([text, None, text]))
    w = kernels.Words(data, offsets)
    code, plain = kernels.word_codes(w), words(text) * 2
    assert len(set(zip(code.tolist(), plain))) == len(set(plain)) == len(set(code.tolist()))
    assert kernels.joined(w, np.ones(len(code), bool)).to_pylist() == [
        " ".join(words(text)), "", " ".join(words(text))]
