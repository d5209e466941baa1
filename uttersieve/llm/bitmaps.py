"""A set of 64-bit hashes as a bitmap of bounded size, for sieving rows before a shuffle.

It has ``SPARE`` bits for each hash, but never more than ``2**MOST_BITS`` (16 MB), so it
can be sent to every task however large the set is.  A hash sets three bits.  It only
sieves: rows of the set always pass, others pass when their bits are taken by chance.  What follows must be
exact by itself; with a set of a billion hashes the sieve lets nearly all through
and the result is the same.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.llm import kernels
from uttersieve.session import small_batches

MOST_BITS, LEAST_BITS = 27, 15
SPARE = 32
_SHIFTS = (0, 18, 36)  # where in the hash the numbers of its bits begin
_BUCKET_BITS = 32768  # of Spark's bitmap functions


def build(hashes: DataFrame, hashed: str):
    """Broadcast bitmap of the column ``hashed`` (counted first, so give a table)."""
    wanted = max(hashes.count(), 1) * SPARE
    size = 1 << min(max(wanted.bit_length(), LEAST_BITS), MOST_BITS)
    mask = F.lit(size - 1).cast("bigint")
    slots = [F.shiftright(F.col(hashed), n).bitwiseAND(mask) for n in _SHIFTS]
    parts = (
        hashes.select(F.explode(F.array(*slots)).alias("s"))
        .select(F.shiftright("s", 15).alias("b"), F.col("s").bitwiseAND(_BUCKET_BITS - 1).alias("p"))
        .groupBy("b")
        .agg(F.bitmap_construct_agg("p").alias("bits"))
    )
    out = np.zeros(size // 8, np.uint8)
    width = _BUCKET_BITS // 8
    for r in parts.toLocalIterator():
        out[r["b"] * width : (r["b"] + 1) * width] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out.tobytes())


def of_few(hashes: np.ndarray) -> bytes:
    """The bitmap of an array."""
    size = 1 << max((max(len(hashes), 1) * SPARE).bit_length(), LEAST_BITS)
    bits = np.zeros(size, bool)
    for n in _SHIFTS:
        bits[(hashes >> n) & (size - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def contains(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bits are set."""
    table = np.frombuffer(bits, np.uint8)
    hashes = hashes.astype(np.int64, copy=False)
    found = np.arange(len(hashes))
    for n in _SHIFTS:
        at = (hashes[found] >> n) & (len(bits) * 8 - 1)
        found = found[(table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
    out = np.zeros(len(hashes), bool)
    out[found] = True
    return out


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sieve(rows: DataFrame, sent, hashed, inside: bool = True) -> DataFrame:
    """Rows whose ``hashed`` value may be in the set (or, ``inside=False``, the other
    rows, which surely are not); columns stay."""

    def run(batches):
        for batch in batches:
            here = contains(sent.value, batch.column(batch.num_columns - 1).to_numpy())
            kept = batch.select(list(range(batch.num_columns - 1)))
            yield kept.filter(pa.array(here if inside else ~here))

    small_batches(rows.sparkSession)
    return rows.withColumn(fresh(rows, "hash"), hashed).mapInArrow(kernels.lean(run), rows.schema)


def meet(docs: DataFrame, marked: DataFrame, key: str = "doc_id"):
    """``(rest, hit)``: rows of ``docs`` whose ``key`` is surely not in ``marked``, as they
    are, and the others left-joined to ``marked``'s further columns.

    Only the others are shuffled, at every size: ``marked`` grows with the rows, so it is
    never broadcast.  ``marked`` has unique keys, and its further columns
    have names that ``docs`` lacks.  A null key is in no table.
    """
    other = fresh(docs, "other_key")
    marked = marked.withColumnRenamed(key, other)
    sent = build(marked.select(F.xxhash64(other).alias("h")), "h")
    rest = sieve(docs, sent, F.xxhash64(key), inside=False)
    hit = sieve(docs, sent, F.xxhash64(key)).join(
        marked.hint("merge"), F.col(key) == F.col(other), "left"
    )
    return rest, hit.drop(other)
