r"""SimHash near-dedup with pigeonring filtering (operator 13).

A fingerprint has 64 bits; bit ``j`` is 1 if over half of the text's shingle hashes
(XXH64, seed 42, of four lower-cased words joined by a blank, repeats included)
have it.  Fingerprints that differ in at most ``DISTANCE`` bits are linked.

The bits form a ring of ``DISTANCE + 1`` segments.  If two fingerprints are linked,
there is a segment from which every chain of 1, 2, 3 ... consecutive segments
differs in no more than its proportional budget ``length * DISTANCE // segments``: the
averages along a ring cannot exceed the whole one's from every start.  So the first
segment of such a chain is equal, the first two differ by one bit at most, and so on.

* Candidates share a bucket, that is a start and the value of its first segment.
* A bucket of more than ``MOST`` members is split by a longer chain: each member stays
  under the values of its first two (then three) segments, and also visits those that differ
  from them within the chain's budget.  Of two members the one with a 0 in the lowest bit
  of their first difference visits the other.
* Where even three segments leave more, members are dealt into blocks, and any two
  blocks meet in a task of their own: within that bucket, and only there, the work
  is quadratic.
* In a bucket, pairs pass the chain's budgets one after another, and the last chain,
  the whole ring, is the Hamming distance.

Tasks return no pairs but a spanning forest of each batch of buckets, so a crowd of
near copies gives fewer links than rows.  Equal fingerprints are one node from the
start.  Buckets are told apart by a bitmap (:mod:`bitmaps`) of the large ones: a small
one taken for large by chance is split too, with the same result.

Null and wordless texts have fingerprint zero and are linked like any other.  A row
with a null ``doc_id`` has a fingerprint, no links and a null component.  Each row stands for its own
text: rows that share an id but not the text may be in different components.  An
empty table gives no rows.  Extra columns are not looked at.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import bitmaps
from uttersieve.llm.graph import components, look_up
from uttersieve.llm.registry import documents, query
from uttersieve.session import materialize

DISTANCE, SHINGLE, SEED = 4, 4, 42
MOST, BLOCK, LONGEST = 8192, 4096, 3  # members, members of a block, segments of a key
KEY_BITS = 52  # of a bucket's number, below its start
FEW_KEYS = 100_000  # that are sent to every task; more are joined by a shuffle
_HASHES, _HITS = 1 << 16, 1 << 20  # handled at once
_U = np.uint64


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The fingerprint of a text in UTF-8, as Spark's long."""
    flat = b" ".join(text.lower().split())
    if not flat:
        return 0
    blanks = np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.append(blanks, len(flat))
    if len(starts) > k:
        starts, ends = starts[: 1 - k], ends[k - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES):
        spans = zip(starts[at : at + _HASHES].tolist(), ends[at : at + _HASHES].tolist())
        h = np.array([digest(flat[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every row."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"")
                     for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _ring(distance: int):
    """``(first bit, bits)`` of each segment."""
    m = distance + 1
    size = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(size[:i]), n) for i, n in enumerate(size)]


def _chains(distance: int) -> np.ndarray:
    """``[start, length - 1]`` masks of the chains."""
    ring = _ring(distance)
    one = [((1 << n) - 1) << at for at, n in ring]
    m = len(ring)
    return np.array(
        [[sum(one[(s + j) % m] for j in range(n)) for n in range(1, m + 1)] for s in range(m)], _U
    )


def _flips(at: int, size: int, most: int) -> list:
    """Masks of at most ``most`` of the ``size`` bits from bit ``at``."""
    found = [0]
    for b in range(at, at + size):
        found += [mask | 1 << b for mask in found if mask.bit_count() < most]
    return found


def _keys(fp, start, length, distance):
    """Bucket numbers: the start, and the values of the chain's segments side by side."""
    ring = _ring(distance)
    key = np.zeros(len(fp), _U)
    for n in range(length):
        at, size = ring[(start + n) % len(ring)]
        key = (key << _U(size)) | ((fp >> _U(at)) & _U((1 << size) - 1))
    return (key | _U(start << KEY_BITS)).view(np.int64)


_BUCKETS = "key bigint, fp bigint, id bigint"


def _batch(key, fp, node):
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(fp.view(np.int64)), pa.array(node)], names=["key", "fp", "id"]
    )


def buckets(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``key, fp, id`` for each node and start."""

    def run(batches):
        for batch in batches:
            fp, node = (batch.column(i).to_numpy() for i in range(2))
            fp = fp.view(_U)
            for start in range(distance + 1):
                yield _batch(_keys(fp, start, 1, distance), fp, node)

    return nodes.select("fp", "id").mapInArrow(run, _BUCKETS)


def longer(rows: DataFrame, length: int, distance: int = DISTANCE) -> DataFrame:
    """Members of buckets of ``length - 1`` segments under keys of ``length`` segments.

    A member stays under its own value of the next segment, and visits the values that the
    chain's budget, less what it has used to get here, allows.
    """
    m, budget = distance + 1, length * distance // (distance + 1)
    ring, inside = _ring(distance), _U((1 << KEY_BITS) - 1)

    def run(batches):
        for batch in batches:
            key, fp, node = (batch.column(i).to_numpy() for i in range(3))
            key, fp = key.view(_U), fp.view(_U)
            for start in range(m):
                mine = np.flatnonzero(key >> _U(KEY_BITS) == start)
                own, ids, here = fp[mine], node[mine], key[mine]
                used = np.bitwise_count(here ^ _keys(own, start, length - 1, distance).view(_U))
                at, size = ring[(start + length - 1) % m]
                value = _U(start << KEY_BITS) | ((here & inside) << _U(size))
                for mask in _flips(at, size, budget):
                    go = used + mask.bit_count() <= budget
                    if mask:  # of two members at home here only one visits
                        go &= (used > 0) | ((own & _U(mask & -mask)) == 0)
                    one = ((own[go] ^ _U(mask)) >> _U(at)) & _U((1 << size) - 1)
                    yield _batch((value[go] | one).view(np.int64), own[go], ids[go])

    return rows.select("key", "fp", "id").mapInArrow(run, _BUCKETS)


def _roots(n, a, b):
    """For each of ``n`` things the smallest one it hangs together with."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]


def _linked(key, fp, part, distance):
    """Spanning forest ``(i, j)`` of the links within runs of equal ``part``."""
    n = len(fp)
    chain, m = _chains(distance), distance + 1
    edge = np.flatnonzero(part[1:] != part[:-1]) + 1
    end = np.repeat(np.append(edge, n), np.diff(np.concatenate([[0], edge, [n]])))
    start = key >> KEY_BITS
    at, step, root = np.arange(n), 0, np.arange(n)
    found_a, found_b, size = [at], [root], 0
    while len(at):
        step += 1
        at = at[at + step < end[at]]
        live, differ = at, fp[at] ^ fp[at + step]
        for length in range(1, m + 1):
            inside = differ & chain[start[live], length - 1]
            near = np.bitwise_count(inside) <= length * distance // m
            live, differ = live[near], differ[near]
        found_a.append(live)
        found_b.append(live + step)
        size += len(live)
        if size > _HITS or not len(at):
            root = _roots(n, np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, size = [np.arange(n)], [root], 0
    i = np.flatnonzero(root != np.arange(n))
    return i, root[i]


def compare(rows: DataFrame, parts: list, distance: int = DISTANCE) -> DataFrame:
    """Links ``a_id, a_fp, b_id, b_fp`` that join what the buckets' pairs join.  ``parts``
    are the columns that name a bucket; none has more than about ``MOST`` members."""

    def close(held):
        key, fp, node, part = (np.concatenate(x) for x in zip(*held))
        i, j = _linked(key, fp.view(_U), part, distance)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (node[i], fp[i], node[j], fp[j])],
            names=["a_id", "a_fp", "b_id", "b_fp"],
        )

    def run(batches):
        held, serial = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            name = np.stack(columns[3:])
            # a number per bucket, going on where the last batch ended
            opens = np.ones(batch.num_rows, bool)
            opens[1:] = (name[:, 1:] != name[:, :-1]).any(axis=0)
            if held and (held[-1][4] == name[:, 0]).all():
                opens[0] = False
            part = serial + np.cumsum(opens)
            serial = int(part[-1])
            last = np.searchsorted(part, serial)  # the open bucket begins here
            if last or opens[0]:
                whole = [*held, (*columns[:3], part, name[:, -1])]
                cut = [tuple(x[:last] for x in whole[-1][:4])]
                done = [h[:4] for h in whole[:-1]] + cut
                if sum(len(d[0]) for d in done):
                    yield close(done)
                held = []
            held.append((*(x[last:] for x in columns[:3]), part[last:], name[:, -1]))
        if held:
            yield close([h[:4] for h in held])

    extra = [F.col(c).cast("bigint").alias(f"part{i}") for i, c in enumerate(parts)]
    dealt = rows.select("key", "fp", "id", *extra)
    names = [f"part{i}" for i in range(len(parts))]
    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(
        run, "a_id bigint, a_fp bigint, b_id bigint, b_fp bigint"
    )


def _cells(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Members of buckets beyond ``MOST`` for every two blocks: ``key, fp, id, i, j``."""
    sizes = large.select(
        F.col("key").alias("_key"), F.ceil(F.col("n") / BLOCK).cast("int").alias("_blocks")
    )
    if large.count() <= FEW_KEYS:
        sizes = F.broadcast(sizes)
    mine = F.pmod(F.xxhash64("fp"), F.col("_blocks")).cast("int")
    return (
        rows.join(sizes, F.col("key") == F.col("_key"))
        .withColumn("_mine", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(
            "key", "fp", "id",
            F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j"),
        )
    )


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links between different fingerprints; ``nodes`` has ``fp, id``, each ``fp`` once.

    Not all of them: enough to connect what is connected.
    """
    found, rows = [], buckets(nodes, distance)
    for length in range(1, LONGEST + 1):
        large = materialize(
            rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > MOST), "large"
        )
        if not large.limit(1).count():
            found.append(compare(rows, ["key"], distance))
            break
        if length == LONGEST:
            small = rows.join(large.select("key"), "key", "left_anti")
            found.append(compare(small, ["key"], distance))
            found.append(compare(_cells(rows, large), ["key", "i", "j"], distance))
            break
        sent = bitmaps.build(large, "key")
        found.append(compare(bitmaps.sieve(rows, sent, F.col("key"), False), ["key"], distance))
        split = bitmaps.sieve(rows, sent, F.col("key"))
        rows = materialize(longer(split, length + 1, distance), "buckets")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    rows = materialize(fingerprints(docs), "fingerprints")
    known = rows.filter("doc_id is not null")
    nodes = materialize(
        known.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "nodes"
    )
    # a node is its smallest id and its fingerprint, in this order, so the smallest node
    # of a component has the smallest id
    pairs = links(nodes, distance).select(
        F.struct(F.col("a_id").alias("id"), F.col("a_fp").alias("fp")).alias("a"),
        F.struct(F.col("b_id").alias("id"), F.col("b_fp").alias("fp")).alias("b"),
    )
    parts = components(materialize(pairs, "pairs")).select(
        F.col("node.fp").alias("fp"), F.col("component_id.id").alias("_least")
    )
    named = materialize(
        nodes.join(parts, "fp", "left").select(
            "fp", "n", F.coalesce("_least", "id").alias("component_id")
        ),
        "named",
    )
    return look_up(rows, named, "fp", "n").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    )


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Rows of ``docs`` that are the first of their component, and those without an id."""
    first = near_duplicates(docs, distance).filter("doc_id = component_id")
    name = bitmaps.fresh(docs, "first_id")
    first = first.select(F.col("doc_id").alias(name)).distinct()
    loose = docs.filter("doc_id is null")
    return docs.join(first, F.col("doc_id") == F.col(name), "left_semi").unionByName(loose)


@query("op13_pigeonring")
def op13(spark, folder):
    """Fingerprint and component of every document."""
    found = near_duplicates(documents(spark, folder))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
