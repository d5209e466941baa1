"""Size-limited folders: next-fit packing in order, parallel within one subset.

Going through the clips of a subset in order, a new folder starts where the
current size plus the next clip would exceed the limit.  An over-size clip also
starts a folder, even as the very first clip (folder 1 then stays empty).

The fold is sequential, yet a block of rows acts on the size it is entered with
in a way that depends only on *which* of its rows is the first to start a
folder.  Those rows all lie in the block's first ``limit`` bytes.  So:

1. every block, in parallel, lists its possible first starts with the folders
   opened and the size left at its end: a piecewise function of the size it is entered with;
2. these functions are composed up a tree, ``FAN`` neighbours at a time (composition is
   associative, and a list never outgrows those of its parts);
3. down the tree every block learns the folder and the size it is entered with;
4. every block, in parallel, is cut into folders.

The lists of ``FAN`` blocks are the most that a task holds, however large a subset is.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttersieve.functions.text import folder_name
from uttersieve.operators.order import BLOCK_ROWS, block_of, join_ranges
from uttersieve.schema import FOLDER_LIMIT
from uttersieve.session import materialize

FAN = 8  # functions that are composed in one task
PACK_ROWS = 1 << 18  # clips of a block
_NEVER = np.iinfo(np.int64).max


def next_starts(sizes: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """For a folder that starts at row i: the row that starts the next one."""
    fits_until = np.searchsorted(ends, ends - sizes + limit, side="right")
    return np.maximum(np.arange(1, len(sizes) + 1), fits_until)


def block_effects(sizes: np.ndarray, limit: int):
    """Arrays ``(upto, opened, left)``, one entry per possible first start.

    Entered with size c, the entry that applies is the first whose ``upto``
    (bytes up to and including that row) exceeds ``limit - c``.  An entry with
    ``opened == 0`` stands for "no start"; its ``left`` adds to c.
    """
    ends = np.cumsum(sizes)
    n = len(sizes)
    first = np.arange(min(np.searchsorted(ends, limit, side="right") + 1, n))
    following = next_starts(sizes, ends, limit)
    at, opened = first.copy(), np.ones(len(first), dtype=np.int64)
    while True:
        step = following[at]
        more = step < n
        if not more.any():
            break
        at = np.where(more, step, at)
        opened += more
    upto, left = ends[first], ends[-1] - (ends[at] - sizes[at])
    if ends[-1] <= limit:
        upto, opened, left = (
            np.append(upto, _NEVER),
            np.append(opened, 0),
            np.append(left, ends[-1]),
        )
    # after an empty clip the bound does not grow: the first entry applies
    grows = np.append(True, upto[1:] > upto[:-1])
    return _merged(upto[grows], opened[grows], left[grows])


def _merged(upto, opened, left):
    """Neighbours with one effect are one entry, the later bound."""
    last = np.append((opened[1:] != opened[:-1]) | (left[1:] != left[:-1]), True)
    return upto[last], opened[last], left[last]


def composed(one, two, limit: int):
    """The effect of one block followed by another; arrays as in :func:`block_effects`.

    Where the first block starts a folder, what it leaves does not depend on its entry,
    so each of its entries meets one of the second's.  Where it does not, its bytes only move
    the second one's bounds.
    """
    upto, opened, left = one
    starts = opened > 0
    hit = np.searchsorted(two[0], limit - left[starts], side="right")
    adds = two[1][hit] == 0
    out = [
        upto[starts],
        opened[starts] + two[1][hit],
        two[2][hit] + np.where(adds, left[starts], 0),
    ]
    if not starts.all():  # the last entry
        total, bound = left[-1], upto[-2] if len(upto) > 1 else np.iinfo(np.int64).min
        moved = np.where(two[0] == _NEVER, _NEVER, np.minimum(two[0], _NEVER - total) + total)
        above = moved > bound
        more = (moved, two[1], two[2] + np.where(two[1] == 0, total, 0))
        out = [np.append(x, y[above]) for x, y in zip(out, more)]
    return _merged(*out)


def entered(effect, folder: int, held: int, limit: int):
    """Folder and size after a block that is entered with ``folder, held``."""
    upto, opened, left = effect
    hit = int(np.searchsorted(upto, limit - held, side="right"))
    return folder + int(opened[hit]), int(left[hit]) + (held if opened[hit] == 0 else 0)


def cut_block(sizes: np.ndarray, folder: int, held: int, limit: int):
    """Rows at which runs of one folder begin, and each run's folder number."""
    ends = np.cumsum(sizes)
    following = next_starts(sizes, ends, limit)
    at = int(np.searchsorted(ends, limit - held, side="right"))
    starts, folders = ([0], [folder]) if at > 0 else ([], [])
    while at < len(sizes):
        folder += 1
        starts.append(at)
        folders.append(folder)
        at = int(following[at])
    return np.array(starts), np.array(folders)


def folder_ranges(
    df: DataFrame,
    keys=("subset",),
    seq="seq",
    size="size",
    limit=FOLDER_LIMIT,
    block_rows=PACK_ROWS,
) -> DataFrame:
    """One row per run of consecutive clips in one folder of one block:
    ``keys, _block, folder_index, first_seq, last_seq, clips, bytes``.

    Only ``(keys, seq, size)`` is read: about 24 bytes per clip.  ``keys`` and ``seq``
    are not null.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys] + [T.StructField("_block", T.LongType())]

    def longs(*names):
        return T.StructType(key_fields + [T.StructField(n, T.LongType()) for n in names])

    rows = df.select(
        *keys,
        block_of(seq, block_rows).alias("_block"),
        F.col(seq).cast("bigint").alias("_seq"),
        F.col(size).cast("bigint").alias("_size"),
    )

    def with_key(key, columns):
        n = len(next(iter(columns.values())))
        names = dict(zip([*keys, "_block"], key))
        return pa.table({**{k: pa.repeat(v, n) for k, v in names.items()}, **columns})

    def in_order(table):
        seqs, sizes = (table[c].to_numpy() for c in ("_seq", "_size"))
        order = np.argsort(seqs, kind="stable")
        return seqs[order], sizes[order]

    def effects(key, table):
        upto, opened, left = block_effects(in_order(table)[1], limit)
        return with_key(key, {"_upto": upto, "_opened": opened, "_left": left})

    def functions(table):
        """``(block, effect)`` of the blocks in a task's table, in order."""
        blocks, upto, opened, left = (
            table[c].to_numpy() for c in ("_block", "_upto", "_opened", "_left")
        )
        order = np.lexsort((upto, blocks))
        blocks, parts = blocks[order], [x[order] for x in (upto, opened, left)]
        edges = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1, append=blocks[-1:] + 1))
        for lo, hi in zip(edges[:-1], edges[1:]):
            yield int(blocks[lo]), [x[lo:hi] for x in parts]

    def up(key, table):
        whole = None
        for _, effect in functions(table):
            whole = effect if whole is None else composed(whole, effect, limit)
        return with_key(key, dict(zip(("_upto", "_opened", "_left"), whole)))

    def down(key, table):
        is_entry = pc.is_valid(table["_folder"])
        entry = table.filter(is_entry)
        folder, held = entry["_folder"][0].as_py(), entry["_held"][0].as_py()
        out = []
        for block, effect in functions(table.filter(pc.invert(is_entry))):
            out.append((block, folder, held))
            folder, held = entered(effect, folder, held, limit)
        blocks, folders, sizes = (np.array(x, np.int64) for x in zip(*out))
        own = with_key(key, {"_folder": folders, "_held": sizes})
        return own.set_column(own.column_names.index("_block"), "_block", pa.array(blocks))

    def cut(key, table):
        is_entry = pc.is_valid(table["_folder"])
        entry = table.filter(is_entry)
        seqs, sizes = in_order(table.filter(pc.invert(is_entry)))
        folder, held = 1, 0  # a subset's first block
        if entry.num_rows:
            folder, held = entry["_folder"][0].as_py(), entry["_held"][0].as_py()
        starts, folders = cut_block(sizes, folder, held, limit)
        ends = np.append(starts[1:], len(sizes))
        return with_key(
            key,
            {
                "folder_index": folders,
                "first_seq": seqs[starts],
                "last_seq": seqs[ends - 1],
                "clips": ends - starts,
                "bytes": np.add.reduceat(sizes, starts),
            },
        )

    def grouped(fn, table, columns, by="_block"):
        return table.groupBy(*keys, by).applyInArrow(fn, longs(*columns))

    def with_parent(level):
        return level.withColumn("_of", F.floor(F.col("_block") / FAN).cast("bigint"))

    effect, entry = ("_upto", "_opened", "_left"), ("_folder", "_held")
    levels, blocks = [], (rows.agg(F.max("_block")).first()[0] or 0) + 1
    while blocks > 1:
        if not levels:
            found = grouped(effects, rows, effect)
        else:
            found = grouped(up, with_parent(levels[-1]), effect, "_of")
        levels.append(materialize(found, "effects"))
        blocks = -(-blocks // FAN)
    entries = None
    for below in reversed(levels):
        # the tree's top is entered with folder 1 and no bytes, then each level with its parent's
        if entries is None:
            entries = below.select(*keys, F.lit(0).cast("bigint").alias("_of")).distinct().select(
                *keys, "_of", F.lit(1).cast("bigint").alias("_folder"),
                F.lit(0).cast("bigint").alias("_held"),
            )
        else:
            entries = entries.withColumnRenamed("_block", "_of")
        both = with_parent(below).unionByName(entries, allowMissingColumns=True)
        entries = grouped(down, both, entry, "_of")
    if entries is not None:
        rows = rows.unionByName(entries, allowMissingColumns=True)
    else:
        rows = rows.withColumns({c: F.lit(None).cast("bigint") for c in entry})
    return grouped(
        cut, rows, ("folder_index", "first_seq", "last_seq", "clips", "bytes")
    )


def assign_folders(
    df: DataFrame, ranges: DataFrame, keys=("subset",), seq="seq", block_rows=BLOCK_ROWS
) -> DataFrame:
    """Add ``folder_index`` to rows of any width (see :func:`join_ranges`)."""
    return join_ranges(df, ranges, keys, seq, take=["folder_index"], block_rows=block_rows)


def folder_totals(ranges: DataFrame, keys=("subset",)) -> DataFrame:
    """Bytes and clips of every folder, from the ranges alone."""
    return ranges.groupBy(*keys, "folder_index").agg(
        F.sum("bytes").alias("bytes"), F.sum("clips").alias("clips")
    )


def entry_path(folder="folder_index", utt_id="utt_id"):
    """Path of a clip inside its archive."""
    return F.concat(folder_name(folder), F.lit("/audio/"), F.col(utt_id), F.lit(".wav"))
