r"""Periodic run detection (operator 11): a dictionary of basic factors.

Words are ``[^\x20\x09-\x0D]+``, compared whole.  A run is a stretch of consecutive words with
smallest period ``q``, at least ``LEAST_WORDS`` words and ``LEAST_TURNS`` periods long,
that no neighbouring word extends keeping the period.

The dictionary names every stretch of 1, 2, 4, 8 ... words of a text, so that two
stretches of one length have one name if and only if they are equal: the name of ``2 L``
words is the pair of names of their halves.  Names that occur once in a text are
left out, what begins there cannot recur.  For each length ``L`` every occurrence
meets its successor.  Those at most ``L`` words later, so that both lie within ``2 L``
words, form arithmetic progressions, whose difference is proposed as a period;
progressions that begin at neighbouring words are one proposal.  Each proposal is
extended word by word to both sides, and equal ones of several lengths are one run.

Every run of three periods is proposed: at the first length ``L >= q`` the stretches
at its first and at its ``q``-th word are equal, and an earlier successor would give the run a
smaller period (Fine and Wilf).  For the same reason ``q`` is its smallest period.

Texts are taken about a megabyte at a time, whole documents each, so memory depends on the
longest one only, and no row leaves its task.  Null and blank texts have no words and no
runs.  Every row is judged by itself: repeated rows, null or repeated ids change
nothing.  Extra columns are not looked at.  An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import kernels
from uttersieve.llm.registry import documents, query

LEAST_WORDS, LEAST_TURNS = 24, 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _names(key: np.ndarray, place: np.ndarray):
    """``(place, name)`` of the keys that occur more than once, in order of place, and for
    each the distance to its successor (0: none)."""
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    follows, leads = same[:-1], same[1:]
    again = follows | leads
    name = np.cumsum(~follows)[again]
    gap = np.zeros(len(key), np.int64)
    gap[leads] = place[np.flatnonzero(leads) + 1] - place[leads]
    place, gap = place[again], gap[again]
    back = np.argsort(place)
    return place[back], name[back], gap[back]


def _proposals(place, gap, length):
    """``(start, end, period)`` of the progressions of one length."""
    near = (gap > 0) & (gap <= length)
    place, gap = place[near], gap[near]
    order = np.lexsort((place, gap))
    place, gap = place[order], gap[order]
    opens = np.ones(len(place), bool)
    opens[1:] = (gap[1:] != gap[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(place))[: len(first)] - 1
    return place[first], place[last] + gap[last] + length, gap[first]


def _extended(code, low, high, start, end, period):
    """Both ends moved while the words agree with those a period away."""
    for side in (-1, 0):
        live = np.arange(len(start))
        while len(live):
            if side:
                live = live[start[live] > low[live]]
                at = start[live] - 1
                live = live[code[at] == code[at + period[live]]]
                start[live] -= 1
            else:
                live = live[end[live] < high[live]]
                live = live[code[end[live]] == code[end[live] - period[live]]]
                end[live] += 1
    return start, end


def runs(code: np.ndarray, first: np.ndarray, words=LEAST_WORDS, turns=LEAST_TURNS):
    """``(start, length, period)`` arrays of all runs, sorted by start, then period.

    ``code`` numbers the words of several documents, ``first`` has each one's first word
    (one entry more than documents); starts count from the first document's.
    """
    n = len(code)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found = [np.zeros((0, 3), np.int64)]
    place, name, gap = _names(doc * (int(code.max(initial=0)) + 1) + code, np.arange(n))
    length = 1
    while len(place):
        start, end, period = _proposals(place, gap, length)
        own = doc[start]
        start, end = _extended(code, first[own], first[own + 1], start, end, period)
        long = end - start >= np.maximum(words, turns * period)
        found.append(np.stack([start, end - start, period], axis=1)[long])
        # the dictionary of twice the length; a name is one document's, so are both halves
        named = np.full(n + length, -1, np.int64)
        named[place] = name
        second = named[place + length]
        whole = (second >= 0) & (place + 2 * length <= first[doc[place] + 1])
        key = name[whole] * (int(name.max()) + 1) + second[whole]
        place, name, gap = _names(key, place[whole])
        length *= 2
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _dropped(found: np.ndarray, n: int) -> np.ndarray:
    """Which words some run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def _measured(data, offsets):
    """``(words, first, runs, kept text)`` of a piece of a column of texts."""
    w = kernels.Words(data, offsets)
    found = runs(kernels.word_codes(w), w.first)
    kept = kernels.joined(w, ~_dropped(found, len(w.starts)))
    return w, found, kept


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row: the runs sorted by start, then
    period, and the words outside repetitions, joined by one blank."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in kernels.chunks(batch.column(1)):
                w, found, kept = _measured(data, offsets)
                at = np.searchsorted(found[:, 0], w.first)
                # starts count from the document's own first word
                own = np.searchsorted(w.first, found[:, 0], side="right") - 1
                start = found[:, 0] - w.first[own]
                values = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start, found[:, 1], found[:, 2])],
                    fields=list(_RUN),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array(np.diff(w.first), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), values),
                        kept,
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string"
    )


def collapsed(docs: DataFrame) -> DataFrame:
    """``docs`` with each repetition cut down to its first period; texts without
    a run, and all other columns, stay as they are."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in kernels.chunks(batch.column(at)):
                w, found, kept = _measured(data, offsets)
                hit = np.diff(np.searchsorted(found[:, 0], w.first)) > 0
                part = batch.slice(lo, hi - lo)
                columns = list(part.columns)
                text = columns[at]
                columns[at] = pa.compute.if_else(pa.array(hit), kept.cast(text.type), text)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def with_planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a tenth of the texts made periodic, as the contract says.

    ``h = crc32(doc_id)`` chooses them; word ``i >= a`` becomes word ``a + (i - a) % p``.
    """
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("_h"))
    for name, column in [
        ("_w", F.when(
            F.col("_h") % 10 == 0,
            F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), ""),
        )),
        ("_g", F.expr("_h div 10")),
        ("_n", F.size("_w")),
        ("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n"))),
        ("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)")),
    ]:
        rows = rows.withColumn(name, column)
    periodic = F.expr(
        "array_join(transform(_w, (x, i) -> "
        "if(i < _a, x, get(_w, cast(_a + (i - _a) % _p as int)))), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("_n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The greatest run and checksums in place of the lists and texts."""
    # the first of the runs that no other exceeds: they are sorted by start, then period
    best = F.expr(
        "aggregate(runs, get(runs, 0), (b, r) -> "
        "if(r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr(
        "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')"
    )
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_basic_factors")
def op11(spark, folder):
    """The runs of every document, a tenth of them with planted ones."""
    return digest(repeated_runs(with_planted(documents(spark, folder))))
