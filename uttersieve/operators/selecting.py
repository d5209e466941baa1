"""Choose rows: by id, by place, by what is already done."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttersieve.operators.order import positions
from uttersieve.session import materialize


def with_ids(df: DataFrame, ids: DataFrame, id_col="utt_id") -> DataFrame:
    """Rows whose id is in the list.  No broadcast hint: the list grows with the
    corpus, so Spark broadcasts it only where its size is known to be small."""
    return df.join(ids.select(id_col), id_col, "left_semi")


def without_done(todo: DataFrame, done: DataFrame, on) -> DataFrame:
    """Rows that have no output yet."""
    on = [on] if isinstance(on, str) else list(on)
    return todo.join(done.select(*on), on, "left_anti")


def with_literal_ids(df: DataFrame, ids, id_col="utt_id") -> DataFrame:
    """Rows whose id is in a list of any length: the list becomes a table."""
    field = T.StructType([T.StructField(id_col, df.schema[id_col].dataType)])
    return with_ids(df, df.sparkSession.createDataFrame([(i,) for i in ids], field), id_col)


def from_index(df: DataFrame, start: int, overlap=False, seq="seq") -> DataFrame:
    """Rows from 0-based index ``start`` on; ``overlap`` repeats the row before.

    ``seq`` is that index, so this is a range predicate the scan can skip by.
    """
    first = max(start - 1, 0) if overlap else start
    return df.filter(F.col(seq) >= first)


def from_marks(df: DataFrame, marks: DataFrame, keys=("subset",), seq="seq") -> DataFrame:
    """Rows past each key's high-water mark; keys without a mark start at the top.

    The marks, one row per key, are written down first: their size is known, so
    the rows need not be shuffled to meet them.
    """
    marks = materialize(marks.select(*keys, "mark"), "marks")
    return (
        df.join(marks, list(keys), "left")
        .filter(F.col("mark").isNull() | (F.col(seq) > F.col("mark")))
        .drop("mark")
    )


def high_water_marks(done: DataFrame, keys=("subset",), seq="seq") -> DataFrame:
    """Last processed ``seq`` per key, from the output itself.

    Valid where rows were processed in ``seq`` order; where files finished out of
    order use :func:`without_done`, which is exact either way.
    """
    return done.groupBy(*keys).agg(F.max(seq).alias("mark"))


def first_rows(df: DataFrame, n: int, order=("seq",)) -> DataFrame:
    """The first ``n`` rows (a top-k: each task sends at most ``n``)."""
    return df.orderBy(*order).limit(n)


def nth_row(df: DataFrame, n: int, seq="seq") -> DataFrame:
    """The row with 0-based index ``n``, found by its position.

    The positions are those of ``seq`` alone: the rows, with their texts, stay where they
    are, and only those that share the found ``seq`` are put in order.
    """
    at = positions(df.select(seq), [], seq, "_at").filter(F.col("_at") == n + 1).first()
    if at is None:
        return df.filter(F.lit(False))
    here, value = F.col(seq), F.lit(at[seq]).cast(df.schema[seq].dataType)
    # null comes first
    earlier = 0 if at[seq] is None else df.filter(here.isNull() | (here < value)).count()
    # rows of one seq stand in the order of their other columns, as far as they have one
    others = [f.name for f in df.schema if f.name != seq and not _unordered(f.dataType)]
    same = df.filter(here.eqNullSafe(value))
    return (same.orderBy(*others) if others else same).offset(n - earlier).limit(1)


def _unordered(kind) -> bool:
    """Whether Spark has no order for the type: a map, or what holds one."""
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def subset_sizes(df: DataFrame, size="size", keys=("subset",)) -> DataFrame:
    """Rows and bytes per subset, and in one more row (``whole``, null key) of all.

    ``whole`` tells the total from a subset whose name is null.
    """
    return df.rollup(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(size)).alias("n_bytes"),
        (F.grouping_id() > 0).alias("whole"),
    )


def subset_hours(df: DataFrame, samples="samples", rate="rate") -> DataFrame:
    """Subsets by hours of audio, longest first.

    Sample counts add up as integers per rate, so the sum does not depend on
    the order the rows come in.
    """
    per_rate = df.groupBy("subset", rate).agg(
        F.sum(F.size(samples).cast("bigint")).alias("_n")
    )
    return (
        per_rate.groupBy("subset")
        .agg((F.sum(F.col("_n") / F.col(rate)) / 3600).alias("hours"))
        .orderBy(F.desc("hours"), "subset")
    )
