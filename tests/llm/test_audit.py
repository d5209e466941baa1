"""The filter audit against its SQL twin and against the orders played through."""

import re
from itertools import permutations

import compare
import duckdb
import pytest
from fixtures import awkward, clashing, nothing, prose, words

from uttersieve.llm import audit
from uttersieve.llm.registry import TWINS

LABELS = [(10, 1, 0), (11, 1, 1), (12, 0, 1), (26, 1, 0), (None, 1, 1), (11, 0, 0), (77, 1, 1),
          (18, None, 1), (21, 1, None), (40, 1, 1)]


def tables(spark, docs=None):
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    return awkward(spark) if docs is None else docs, labels


def crowd(spark):
    """Many copies of a few texts that fail other filters, in several parts."""
    texts = [prose(1, 250, 3000), prose(2, 250, 40), "A B # " * 70, prose(3, 30), "", None]
    return spark.createDataFrame(
        [(i, texts[i * i % 6], ("en", "", None, "de")[i % 4]) for i in range(400)],
        "doc_id bigint, text string, lang string",
    )


def twin(docs, labels):
    con = duckdb.connect()
    frames = docs.toArrow(), labels.toArrow()
    con.register("documents", frames[0])
    con.register("labels", frames[1])
    return con, TWINS["op12_filter_audit"], frames


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("source", ["awkward", "twice", "crowd"])
def test_twin(spark, monkeypatch, source, hot):
    if hot:  # every shared text counts as hot
        monkeypatch.setattr(audit, "HOT_SHARE", 0)
        monkeypatch.setattr(audit, "DEAL_ROWS", 2)
    docs = crowd(spark) if source == "crowd" else awkward(spark)
    docs, labels = tables(spark, docs.union(docs) if source == "twice" else docs)
    con, sql, _held = twin(docs, labels)
    assert compare.differences(audit.audit(clashing(docs), clashing(labels)), con, sql) == []


def played(docs, labels):
    """Rows of the audit, by removing documents order by order."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}

    def fails(i, t):
        t = t or ""
        w = words(t)
        return "".join(letter for letter, failed in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w),
            100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search(r"[#$%&*|]", t),
            i is not None and first[t] < i)) if failed)

    out, sums = {}, {}
    for part in {p or "" for _, _, p in docs}:
        own = [(i, fails(i, t)) for i, t, p in docs if (p or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = (
                    len(left), len(removed), sum(f in r[1] for r in own) - len(removed),
                    sum(r[1] == f for r in own), sum(r[0] in good for r in removed),
                    sum(r[0] in toxic for r in removed))
                sums[part, f] = sums.get((part, f), 0) + len(removed)
    return {(*k, *v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_orders_played_through(spark):
    docs, labels = tables(spark, awkward(spark).select("doc_id", "text", "lang"))
    got = {tuple(r) for r in audit.audit(docs, labels).collect()}
    want = played([tuple(r) for r in docs.collect()], LABELS)
    assert got == want and len(got) == 600 * 3


def test_copies_are_marked_once(spark):
    docs, _ = tables(spark)
    rows = audit.failures(docs)
    marked = sorted(r["doc_id"] for r in audit.copies(docs, rows).collect())
    # 11 has 10's text, 17 is empty as 16; both rows of 26 are of one id
    assert marked == [11, 17]


def test_nothing(spark):
    docs, labels = tables(spark, nothing(spark))
    assert audit.audit(docs, labels).count() == 0
    docs, labels = tables(spark)
    assert audit.audit(docs, labels.limit(0)).count() == 600 * 3
