"""Sharding by histogram sort (operator 3): shards of equal bytes in key order.

The sort key is ``(hash of the text, doc_id)``.  Cutting it into shards of equal
bytes needs the keys at which so many bytes lie below.  Each round sends a few
candidate keys per boundary (probes) to all partitions, which count the exact
bytes and rows between probes; the sums narrow each boundary's interval until a
probe is within the tolerance of its target, or the interval is one key.  First
hashes are probed, so equal texts stay in one shard where the tolerance allows
it; inside a text whose copies alone exceed it, ids are probed.  Then every row
knows its shard, and rows are exchanged once.

Shards are cut further into ranges, one of which a task sorts.  Hashes of different texts
are spread evenly, so equal steps of the hash are about equal bytes; a range that copies or
long texts make larger than twice ``RANGE_BYTES`` is cut by probing, too.  So ranges
stay about as large however large the table is.  Whole rows move, once, to their range,
and a range's first slot is a sum of counts.  The driver sees probes and their sums only: at most
``PROBES`` per boundary and round, for ``AT_ONCE`` boundaries at a time.

Law: ``bytes``.  Every shard's bytes are within ``TOLERANCE`` of an equal share, or
within the rows of one key where a single key is larger than that.  A null text is
none: its bytes are 0, its size 16, its checksum that of no bytes.  A null ``doc_id``
sorts first among equal texts.  Rows that agree in text and id stay in one shard.
Extra columns are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize

SHARDS = 40
ROW_BYTES = 16  # counted for each row besides its text
TOLERANCE = 0.002  # of a shard's equal share
PROBES = 32  # per open boundary and round
RANGE_BYTES = 256 << 20
AT_ONCE = 1024  # boundaries that are searched for together
_LOW, _HIGH = -(2**63), 2**63 - 1


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, h, d``: sizes, checksums and the sort key, no texts."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.coalesce("doc_id", F.lit(_LOW)).alias("d"),
    )


def _counts(rows: DataFrame, column: str, probes: dict) -> dict:
    """``group -> (bytes, rows)`` arrays: sums of the gaps between that group's probes.

    ``probes`` maps a group (None: all rows; else a hash) to sorted keys; a row falls
    into gap ``i`` if ``i`` of the keys are not above it.
    """
    flat = {g: np.asarray(p, dtype=np.int64) for g, p in probes.items()}
    groups = np.array(sorted(g for g in flat if g is not None), dtype=np.int64)

    def run(batches):
        sums = {g: np.zeros((2, len(p) + 1), np.int64) for g, p in flat.items()}
        for batch in batches:
            h, key, size = (batch.column(i).to_numpy() for i in range(3))
            parts = [(None, slice(None))] if None in flat else []
            if len(groups):
                at = np.searchsorted(groups, h)
                hit = groups[np.minimum(at, len(groups) - 1)] == h
                parts += [(g, hit & (h == g)) for g in np.unique(h[hit]).tolist()]
            for g, where in parts:
                gap = np.searchsorted(flat[g], key[where], side="right")
                n = len(flat[g]) + 1
                # integer sums: float weights would round above 2**53
                np.add.at(sums[g][0], gap, size[where])
                sums[g][1] += np.bincount(gap, minlength=n)
        for g, both in sums.items():
            gap = np.flatnonzero(both[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([g] * len(gap), pa.int64()),
                    pa.array(gap, pa.int64()),
                    pa.array(both[0][gap], pa.int64()),
                    pa.array(both[1][gap], pa.int64()),
                ],
                names=["g", "gap", "bytes", "n"],
            )

    found = (
        rows.select("h", column, "size")
        .mapInArrow(run, "g bigint, gap bigint, bytes bigint, n bigint")
        .groupBy("g", "gap")
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    )
    out = {g: np.zeros((2, len(p) + 1), np.int64) for g, p in flat.items()}
    for r in found.collect():  # as many rows as probes at most
        out[r["g"]][:, r["gap"]] = r["bytes"], r["n"]
    return out


def _search(rows, column, targets, slack, groups=None):
    """For each target the smallest key found with about so many bytes below it.

    ``targets``: ``[(group, bytes below within the group)]``.  Returns for each target
    ``(key, bytes below, rows below, next)``: ``next`` is None if the boundary is within
    ``slack``, else the key whose rows straddle the target.
    """
    state = [
        {"g": g, "t": t, "lo": _LOW, "hi": _HIGH + 1, "lo_sum": (0, 0), "done": None}
        for g, t in targets
    ]
    while open_ := [s for s in state if s["done"] is None]:
        probes: dict = {}
        for s in open_:
            step = max((s["hi"] - s["lo"]) // (PROBES + 1), 1)
            keys = range(s["lo"] + step, s["hi"], step)
            probes.setdefault(s["g"], set()).update(keys[: PROBES + 1])
        ordered = {g: sorted(k for k in p if k <= _HIGH) for g, p in probes.items()}
        sums = _counts(rows, column, ordered)
        below = {g: np.cumsum(sums[g], axis=1)[:, :-1] for g in ordered}
        for s in open_:
            keys, (b, n) = ordered[s["g"]], below[s["g"]]
            best = min(
                range(len(keys)), key=lambda i: abs(int(b[i]) - s["t"]), default=None
            )
            if best is not None and abs(int(b[best]) - s["t"]) <= slack:
                s["done"] = (keys[best], int(b[best]), int(n[best]), None)
                continue
            for key, kb, kn in zip(keys, b.tolist(), n.tolist()):
                if kb <= s["t"] and key >= s["lo"]:
                    s["lo"], s["lo_sum"] = key, (kb, kn)
                elif kb > s["t"] and key < s["hi"]:
                    s["hi"] = key
            if s["hi"] - s["lo"] <= 1:  # the rows of the key ``lo`` straddle the target
                s["done"] = (s["lo"], *s["lo_sum"], s["lo"])
    return [s["done"] for s in state]


def splitters(rows: DataFrame, targets: list, slack: float) -> list:
    """``[(h, d)]`` for each number of bytes in ``targets``: the boundary with about so many
    bytes below it."""
    out = []
    for at in range(0, len(targets), AT_ONCE):
        part = targets[at : at + AT_ONCE]
        first = _search(rows, "h", [(None, t) for t in part], slack)
        found = [(key, _LOW) for key, _, _, _ in first]
        hot = [(i, key, b) for i, (key, b, _, again) in enumerate(first) if again is not None]
        if hot:
            # the rows of one id, if they straddle the target, go to the nearer side
            second = _search(rows, "d", [(key, part[i] - b) for i, key, b in hot], slack)
            for (i, key, _), (d, _, _, _) in zip(hot, second):
                found[i] = (key, d)
        out += found
    return out


class Cuts:
    """Boundaries ``(h, d)`` in key order, each the begin of a segment, with the segments' shards,
    and the ``steps`` that a segment is cut into by its hashes."""

    def __init__(self, bounds, shards, steps):
        bounds, shards = zip(*sorted(zip(bounds, shards)))
        self.h, self.d = (np.array(x, np.int64) for x in zip(*bounds))
        self.shards, self.steps = list(shards), steps

    def segment(self, h: str, d: str):
        """The segment of a key; rows stay where they are, two numbers go to Python."""
        heads, ties = self.h, self.d

        def find(key: pa.Array, tie: pa.Array) -> pa.Array:
            key, tie = key.to_numpy(zero_copy_only=False), tie.to_numpy(zero_copy_only=False)
            at = np.searchsorted(heads, key, side="left")
            end = np.searchsorted(heads, key, side="right")
            # hashes with boundaries of their own: the last one not above the tie
            for hot in np.unique(key[end > at]).tolist():
                mine = key == hot
                lo, hi = np.searchsorted(heads, hot, "left"), np.searchsorted(heads, hot, "right")
                at[mine] = lo + np.searchsorted(ties[lo:hi], tie[mine], side="right")
            return pa.array(np.maximum(at - 1, 0).astype(np.int32))

        return F.arrow_udf(find, "int")(F.col(h), F.col(d))

    def step(self, segment: str, h: str):
        """The step of a segment that a hash is in: it only rises with the hash."""
        ends = np.append(self.h[1:], _HIGH).astype(float)
        width = np.maximum((ends - self.h) / self.steps, 1.0)
        at = (F.col(segment) + 1).cast("int")
        low = F.element_at(F.lit(self.h.astype(float).tolist()), at)
        raw = F.floor((F.col(h).cast("double") - low) / F.element_at(F.lit(width.tolist()), at))
        return F.greatest(F.least(raw, F.lit(self.steps - 1)), F.lit(0)).cast("int")

    def ranges(self, rows: DataFrame) -> DataFrame:
        """``segment, step, bytes, n`` of the ranges that have rows."""
        inside = rows.withColumn("segment", self.segment("h", "d"))
        return materialize(
            inside.withColumn("step", self.step("segment", "h")).groupBy("segment", "step")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n")),
            "ranges",
        )


def plan(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE):
    """``(cuts, ranges)``: where shards and ranges begin, and the ranges' counts."""
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    targets = [total * i / shards for i in range(1, shards)] if n else []
    bounds = [(_LOW, _LOW), *splitters(rows, targets, tolerance * total / (shards * 2))]
    own = list(range(len(bounds)))
    steps = max(-(-total // (shards * RANGE_BYTES)), 1)
    cuts = Cuts(bounds, own, steps)
    ranges = cuts.ranges(rows)
    order = Window.partitionBy("segment").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("segment").agg(F.sum("bytes").alias("b")).collect()  # one row per shard
    size = {r["segment"]: r["b"] for r in sums}
    large = ranges.withColumn("_to", F.coalesce(F.sum("bytes").over(order), F.lit(0))).filter(
        F.col("bytes") > 2 * RANGE_BYTES
    )
    more, shard_of = [], []
    # at most one of these for every 2 * RANGE_BYTES of the table, and hardly any without copies
    for r in large.toLocalIterator():
        begin = sum(b for g, b in size.items() if g < r["segment"]) + r["_to"]
        parts = -(-r["bytes"] // RANGE_BYTES)
        more += [begin + r["bytes"] * k / parts for k in range(1, parts)]
        shard_of += [cuts.shards[r["segment"]]] * (parts - 1)
    if more:
        found = dict(zip(splitters(rows, more, RANGE_BYTES / 4), shard_of))
        found = {k: s for k, s in found.items() if k not in set(bounds)}
        cuts = Cuts([*bounds, *found], [*own, *found.values()], steps)
        ranges = cuts.ranges(rows)
    return cuts, ranges


def placed(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Every row of ``docs``, all columns, with its ``shard`` and ``slot`` (under such names
    with underscores in front, if ``docs`` has them already), the rows of a range together and in
    key order."""
    keys = materialize(keyed(docs), "keys")
    cuts, ranges = plan(keys, shards, tolerance)
    h, d, segment, step, shard, slot, before = (
        bitmaps.fresh(docs, n) for n in ("h", "d", "segment", "step", "shard", "slot", "before")
    )
    earlier = Window.partitionBy(shard).orderBy(segment, step).rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        ranges.select(
            F.col("segment").alias(segment), F.col("step").alias(step), "n",
            F.element_at(F.lit(cuts.shards), F.col("segment") + 1).cast("int").alias(shard),
        ).withColumn(before, F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"),
        "starts",
    )
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.withColumns({h: F.xxhash64(text), d: F.coalesce("doc_id", F.lit(_LOW))})
    rows = rows.withColumn(segment, cuts.segment(h, d))
    inside = Window.partitionBy(segment, step).orderBy(h, d)
    return (
        rows.withColumn(step, cuts.step(segment, h))
        .join(starts, [segment, step])
        .withColumn(slot, (F.row_number().over(inside) - 1 + F.col(before)).cast("bigint"))
        .select(*docs.columns, shard, slot)
    )


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of the placed rows."""
    found = placed(docs.select("doc_id", "text"), shards, tolerance)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return found.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_histogram_sort")
def op3(spark, folder):
    """Shard and slot of every document."""
    return shard(documents(spark, folder))
