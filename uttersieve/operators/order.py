"""Row numbers, running sums and splits that hold for a key with most of the rows.

A plain window over ``(subset order by seq)`` sorts a whole subset in one task.
Here a subset is cut into blocks of consecutive ``seq`` values.  The totals of
the earlier blocks (one short row per block) enter each block as a head row, so
that the window runs per ``(key, block)`` and never sees more than one block.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uttersieve.session import materialize

BLOCK_ROWS = 1_000_000


def block_of(seq: str, block_rows: int = BLOCK_ROWS) -> Column:
    """Block of a sequence number; ``seq`` is dense, so a block has few rows less
    than ``block_rows`` and never more."""
    return F.expr(f"`{seq}` div {int(block_rows)}")


def running_sums(
    df: DataFrame,
    keys,
    seq: str,
    sums: dict,
    totals: dict | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add running integer sums per key in ``seq`` order, this row included.

    ``sums`` maps a new column name to the integer column to add up; ``totals``
    maps a new column name to one of those names, and gets its total per key.
    """
    keys = list(keys)
    totals = totals or {}
    rows = df.withColumns(
        {
            **{n: F.coalesce(c.cast("bigint"), F.lit(0)) for n, c in sums.items()},
            **{n: F.lit(None).cast("bigint") for n in totals},
            "_block": block_of(seq, block_rows),
            "_is_row": F.lit(True),
        }
    )
    per_block = rows.groupBy(*keys, "_block").agg(*[F.sum(n).alias(n) for n in sums])
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = by_key.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = per_block.select(
        *keys,
        "_block",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums],
        *[F.sum(of).over(by_key).alias(n) for n, of in totals.items()],
        F.lit(False).alias("_is_row"),
    )
    in_block = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_is_row", seq)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(heads, allowMissingColumns=True)
        .withColumns(
            {
                **{n: F.sum(n).over(in_block) for n in sums},
                **{n: F.first(n).over(in_block) for n in totals},
            }
        )
        .filter("_is_row")
        .drop("_block", "_is_row")
    )


def positions(
    df: DataFrame, keys, seq: str, name="position", total=None, block_rows=BLOCK_ROWS
) -> DataFrame:
    """1-based row number per key in ``seq`` order; ``total`` names a count column."""
    return running_sums(
        df, keys, seq, {name: F.lit(1)}, {total: name} if total else None, block_rows
    )


def sorted_positions(
    df: DataFrame, keys, order, name="position", total=None, partitions=None
) -> DataFrame:
    """1-based row number per key for any order columns (e.g. path strings).

    ``keys + order`` must be unique.  Spark range-partitions and sorts the rows;
    the result is written to the shared scratch folder once, because the counts
    and the rows must see the same cut points, also after a lost executor.
    """
    spark = df.sparkSession
    keys, order = list(keys), list(order)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_global", F.monotonically_increasing_id()),
        "sorted",
    ).withColumn("_part", F.shiftright("_global", 33))
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    renamed = {k: f"_k{i}" for i, k in enumerate(keys)}
    counts = placed.groupBy(*keys, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_global").alias("_first")
    )
    offsets = counts.select(
        *[F.col(k).alias(r) for k, r in renamed.items()],
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(by_key).alias(total)] if total else []),
    )
    same = F.col("_part") == F.col("_p")
    for k, r in renamed.items():
        same = same & F.col(k).eqNullSafe(F.col(r))
    return (
        placed.join(offsets, same)
        .withColumn(name, F.col("_before") + F.col("_global") - F.col("_first") + 1)
        .drop("_global", "_part", "_p", "_first", "_before", *renamed.values())
    )


_BITS = 32_768  # positions of one bitmap, as Spark's bitmap functions have it


def seq_bitmaps(df: DataFrame, keys=("subset",), seq="seq") -> DataFrame:
    """``keys, _bucket, _bits``: which ``seq`` occur, a bit each, ``_BITS`` to a row.

    4 KB for up to ``_BITS`` rows, in whatever order they were done.  Every task sets
    its bits before the shuffle.
    """
    s = F.col(seq)
    return (
        df.filter(s >= 0)
        .select(*keys, F.expr(f"`{seq}` div {_BITS}").alias("_bucket"), (s % _BITS).alias("_bit"))
        .groupBy(*keys, "_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )


def not_in_bitmaps(df: DataFrame, bitmaps: DataFrame, keys=("subset",), seq="seq") -> DataFrame:
    """Rows whose ``seq`` has no bit; one look-up per row.  A null ``seq`` has none."""
    keys = list(keys)
    right = bitmaps.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_bucket").alias("_b"),
        "_bits",
    )
    same = F.expr(f"`{seq}` div {_BITS}") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    byte = F.conv(
        F.hex(F.expr(f"substring(_bits, cast(`{seq}` % {_BITS} div 8 as int) + 1, 1)")), 16, 10
    ).cast("int")
    bit = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(`{seq}` % 8 as int))"))
    return df.join(right, same, "left").filter(
        F.col("_bits").isNull() | (bit == 0)
    ).select(*df.columns)


def join_ranges(
    df: DataFrame,
    ranges: DataFrame,
    keys=("subset",),
    seq="seq",
    how="inner",
    take=(),
    block_rows=BLOCK_ROWS,
) -> DataFrame:
    """Join rows to the range their ``seq`` lies in: equal key and cell, then a
    comparison with the cell's ranges.

    A cell is a run of ``seq`` about four times as long as a range is on average, and
    a longer range has a row in each of its cells.  So there are at most a quarter
    more rows than ranges, and however the ranges' lengths differ, all cells together
    compare about ten times for each row: the work is linear in rows and ranges.
    Written to a table first the ranges have a known size, so Spark broadcasts them
    below its threshold (and the wide rows of ``df`` stay where they are) and
    shuffles both sides above it.  ``ranges`` is read twice, so give a table.
    """
    keys = list(keys)
    mean = ranges.agg(F.avg(F.col("last_seq") - F.col("first_seq") + 1)).first()[0] or 1
    cell = min(1 << math.ceil(math.log2(4 * max(mean, 1))), block_rows)
    right = ranges.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.explode(
            F.sequence(F.expr(f"first_seq div {cell}"), F.expr(f"last_seq div {cell}"))
        ).alias("_b"),
        F.col("first_seq").alias("_from"),
        F.col("last_seq").alias("_to"),
        *take,
    )
    same = block_of(seq, cell) == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    same = same & F.col(seq).between(F.col("_from"), F.col("_to"))
    return df.join(right, same, how).select(*df.columns, *take)


def chunk_number(position="position", chunk_rows=200_000) -> Column:
    """1-based chunk of fixed size; the last chunk may be short."""
    return F.expr(f"(`{position}` - 1) div {int(chunk_rows)} + 1")


def split_count(total="total", cap=2, per_split=16) -> Column:
    """How many splits a list of ``total`` items gets."""
    return F.least(F.expr(f"`{total}` div {int(per_split)} + 1"), F.lit(cap)).cast(
        "bigint"
    )


def balanced_split(position="position", total="total", splits=2) -> Column:
    """0-based split of a list cut into ``splits`` nearly equal runs.

    The first ``total % splits`` runs hold one item more than the others.
    """
    n = F.lit(splits).cast("bigint") if isinstance(splits, int) else splits
    at = F.col(position) - 1
    short = F.floor(F.col(total) / n)
    longer = F.col(total) % n
    in_longer = longer * (short + 1)
    return F.when(at < in_longer, F.floor(at / (short + 1))).otherwise(
        longer + F.floor((at - in_longer) / F.greatest(short, F.lit(1)))
    )


def block_split(position="position", total="total", workers=2) -> Column:
    """0-based worker of contiguous runs of ``ceil(total / workers)`` rows."""
    per_worker = F.greatest(F.ceil(F.col(total) / workers), F.lit(1))
    return F.floor((F.col(position) - 1) / per_worker)


def round_robin(split, slots) -> Column:
    """Slot of a split."""
    return F.pmod(F.col(split) if isinstance(split, str) else split, F.lit(slots))
