"""Chart calibration: axis labels to knots, pixels to values."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uttersieve.functions.numbers import has_digit, label_digits, label_value
from uttersieve.session import materialize


def label_parts(lines: DataFrame, column="line") -> DataFrame:
    """Words with a digit, of the lines with a digit."""
    return (
        lines.filter(has_digit(column))
        .withColumn("part", F.explode(F.split(column, r"\s+")))
        .filter(has_digit("part"))
    )


def years(lines: DataFrame, column="line") -> DataFrame:
    """Words of exactly four digits."""
    return label_parts(lines, column).filter(
        (F.length("part") == 4) & F.col("part").rlike("^[0-9]{4}$")
    )


def axis_knots(parts: DataFrame, order, axis="axis", mode="digits") -> DataFrame:
    """Axis map from labels: key = the label's digits, the last label per key wins."""
    keyed = parts.withColumns({"x": label_digits("part"), "_v": label_value("part", mode)})
    return (
        keyed.filter("x is not null")
        .groupBy(axis, "x")
        .agg(F.max_by("_v", F.struct(*order) if len(order) > 1 else order[0]).alias("v"))
    )


def segment_points(segments: DataFrame) -> DataFrame:
    """Line segments ``(x1, y1, x2, y2)`` to one row per end point."""
    ends = F.array(
        F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")),
        F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")),
    )
    return segments.select(
        *[c for c in segments.columns if c not in ("x1", "y1", "x2", "y2")],
        F.inline(ends),
    )


def contour_points(contours: DataFrame, column="points") -> DataFrame:
    """Nested point lists to one row per point."""
    return contours.select(
        *[c for c in contours.columns if c != column], F.inline(F.col(column))
    )


def in_order(contours: DataFrame, column="points", key="id") -> DataFrame:
    """Contours from left to right, by their leftmost point."""
    left = F.array_min(F.transform(F.col(column), lambda p: p["x"]))
    return contours.withColumn("left", left).orderBy("left", key)


def interpolate(
    points: DataFrame, knots: DataFrame, axis="axis", x="x", value="value", partitions=None
) -> DataFrame:
    """Piecewise-linear value of ``x`` between the knots ``(axis, x, v)`` of its
    axis, held constant outside.  Knots are unique per axis and ``x``.

    A point needs the last knot at or before it, so this is an as-of merge: points and
    knots are range-partitioned together by ``(axis, x)`` and sorted, and each point takes the
    knot above it in its part.  Parts are cut by counted rows, and equal ``x`` may be cut too,
    so it does not matter how knots or points lie.  What a part
    begins with, the last knot of the parts before, is a row of its own for each axis and part.

    The parts are written to the shared scratch folder once, because the borders and the
    rows must see the same cut points.  A point without an axis, an ``x`` or any knot has no value.
    """
    spark = points.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_axis = Window.partitionBy(axis).orderBy("x")
    own = knots.select(
        axis, F.col("x").cast("double").alias("x"), F.col("v").cast("double").alias("v")
    ).filter(F.col(axis).isNotNull() & F.col("x").isNotNull())
    spans = own.select(
        axis,
        F.col("x").alias("x0"), F.col("v").alias("v0"),
        F.lead("x").over(by_axis).alias("x1"), F.lead("v").over(by_axis).alias("v1"),
        (F.row_number().over(by_axis) == 1).alias("first"),
    )
    # the first knot's value also holds before it, from a knot without x on
    before = spans.filter("first").select(
        axis, F.lit(None).cast("double").alias("x0"), "v0",
        F.lit(None).cast("double").alias("x1"), F.lit(None).cast("double").alias("v1"),
    )
    spans = before.unionByName(spans.drop("first")).select(
        axis, F.struct("x0", "v0", "x1", "v1").alias("_knot"),
        F.col("x0").alias("_x"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"),
    )
    order = [axis, "_x", "_kind", "_tie"]
    rows = points.withColumns(
        {"_x": F.col(x).cast("double"), "_kind": F.lit(1), "_tie": F.monotonically_increasing_id()}
    )
    placed = materialize(
        rows.unionByName(spans, allowMissingColumns=True)
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()),
        "merged",
    )
    # one row per axis and part
    borders = placed.groupBy(axis, "_part").agg(
        F.max(F.when(F.col("_kind") == 0, F.struct("_x", "_knot")))["_knot"].alias("_knot")
    )
    earlier = Window.partitionBy(axis).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = borders.select(
        axis, "_part", F.last("_knot", ignorenulls=True).over(earlier).alias("_knot"),
        F.lit(-1).alias("_kind"),
    )
    # heads have no x and the least kind, so they come first
    inside = (
        Window.partitionBy(axis, "_part").orderBy(F.col("_kind") >= 0, "_x", "_kind", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        placed.unionByName(heads, allowMissingColumns=True)
        .withColumn("_at", F.last("_knot", ignorenulls=True).over(inside))
        .filter("_kind = 1")
    )
    at = F.col("_x")
    x0, v0, x1, v1 = (F.col(f"_at.{c}") for c in ("x0", "v0", "x1", "v1"))
    return found.withColumn(
        value,
        F.when(at.isNull(), None).when(x1.isNull(), v0).otherwise((v1 - v0) / (x1 - x0) * (at - x0) + v0),
    ).select(*points.columns, value)
