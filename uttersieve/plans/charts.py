"""Queries that calibrate and interpolate plotted points."""

from pyspark.sql import functions as F

from uttersieve.functions.numbers import label_value, month_label
from uttersieve.operators import calibrate as ops
from uttersieve.operators.order import sorted_positions
from uttersieve.plans import views as v
from uttersieve.plans.catalog import query
from uttersieve.schema import MONTHS
from uttersieve.session import scratch_path
from uttersieve.sinks import tables as sinks

_VALUES = """
    points as (select event_id, event_type as axis, value as x from events),
    knots as (select event_type as axis, floor(value / 40) * 40 as x, max(user_id) as v
        from events group by event_type, floor(value / 40) * 40),
    spans as (select axis, x as x0, v as v0,
        lead(x) over (partition by axis order by x) as x1,
        lead(v) over (partition by axis order by x) as v1 from knots),
    ends as (select axis, min(x) as lo, max(x) as hi, arg_min(v, x) as vlo, arg_max(v, x) as vhi
        from knots group by axis),
    valued as (select event_id, p.axis, p.x, cast(case when p.x <= e.lo then e.vlo
            when p.x >= e.hi then e.vhi
            else (s.v1 - s.v0) / (s.x1 - s.x0) * (p.x - s.x0) + s.v0 end as double) as value
        from points p join ends e using (axis)
        left join spans s on p.axis = s.axis and p.x >= s.x0 and p.x < s.x1)"""


def _valued(spark, folder):
    """Every event's value on an axis of its type, with a knot every 40 units."""
    events = v.table(spark, folder, "events")
    points = events.select("event_id", F.col("event_type").alias("axis"), F.col("value").alias("x"))
    knots = events.groupBy(
        F.col("event_type").alias("axis"), (F.floor(F.col("value") / 40) * 40.0).alias("x")
    ).agg(F.max("user_id").alias("v"))
    return ops.interpolate(points, knots)


@query(f"with {_VALUES} select event_id, axis, x, value from valued")
def interpolate(spark, folder):
    """Values of the points between the knots, constant outside."""
    return _valued(spark, folder)


@query(f"with {_VALUES} select distinct x as \"Date\", value as \"Value\" from valued")
def points_file(spark, folder):
    """Distinct points as CSV with a header, read back."""
    path = scratch_path(spark, "points")
    points = _valued(spark, folder).select(F.col("x").alias("Date"), F.col("value").alias("Value"))
    sinks.write_csv(points.distinct().orderBy("Date", "Value"), path)
    return spark.read.schema("Date double, Value double").option("header", True).csv(path)


def _lines(spark, folder):
    return v.table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").alias("x1"),
        F.col("l_extendedprice").alias("y1"),
        F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("y2"),
    )


_ENDS = """(select l_orderkey, l_quantity as x, l_extendedprice as y from lineitem
    union all select l_orderkey, l_discount, l_tax from lineitem)"""


@query(f"select * from {_ENDS}")
def line_endpoints(spark, folder):
    return ops.segment_points(_lines(spark, folder))


@query(f"select distinct x, y from {_ENDS}")
def distinct_points(spark, folder):
    """Distinct end points, sorted by place and value."""
    return ops.segment_points(_lines(spark, folder)).select("x", "y").distinct().orderBy("x", "y")


@query(
    """select vec_id, cast(i as integer) as x, embedding[i] as y
    from embeddings, generate_series(1, 64) g(i)"""
)
def contour_points(spark, folder):
    """Nested point lists to rows."""
    points = F.transform(
        "embedding", lambda e, i: F.struct((i + 1).alias("x"), e.alias("y"))
    )
    contours = v.table(spark, folder, "embeddings").select("vec_id", points.alias("points"))
    return ops.contour_points(contours)


@query(
    """select vec_id, list_min(embedding) as "left", cast(row_number() over
    (order by list_min(embedding), vec_id) as bigint) as place from embeddings"""
)
def contours_in_order(spark, folder):
    """Shapes numbered from left to right."""
    points = F.transform("embedding", lambda e, i: F.struct(e.alias("x"), (i + 1).alias("y")))
    contours = v.table(spark, folder, "embeddings").select("vec_id", points.alias("points"))
    shapes = ops.in_order(contours, key="vec_id").select("vec_id", "left")
    return sorted_positions(shapes, [], ["left", "vec_id"], name="place")


# axis labels made of orders: words, a price in thousands with a unit, a year
_LABEL = """concat('Total ', cast(cast(floor({price} / 1000) as bigint) as {text}), case
    when {key} % 3 = 0 then 'M' when {key} % 3 = 1 then 'B' else '' end, ' in ', {year})"""
_LABEL_SQL = _LABEL.format(
    price="o_totalprice", key="o_orderkey", text="varchar", year="strftime(o_orderdate, '%Y')"
)


def _labels(spark, folder):
    label = _LABEL.format(
        price="o_totalprice", key="o_orderkey", text="string",
        year="date_format(o_orderdate, 'yyyy')",
    )
    orders = v.table(spark, folder, "orders")
    return orders.select("o_orderkey", "o_orderstatus", F.expr(label).alias("line"))


_PARTS = f"""parts as (select o_orderkey, o_orderstatus, part from (
    select o_orderkey, o_orderstatus, unnest(string_split({_LABEL_SQL}, ' ')) as part from orders)
    where regexp_matches(part, '[0-9]')),
    read as (select *, cast(regexp_replace(part, '[^0-9]', '', 'g') as bigint) as number,
        cast(regexp_replace(part, '[^0-9]', '', 'g') as bigint) * case
            when contains(part, 'M') then 1000000 when contains(part, 'B') then 1000000000
            else 1 end as value from parts)"""


@query(f"with {_PARTS} select o_orderkey, part, cast(value as bigint) as value from read")
def axis_numbers(spark, folder):
    """Number labels and their values."""
    parts = ops.label_parts(_labels(spark, folder))
    return parts.select("o_orderkey", "part", label_value("part").alias("value"))


@query(f"with {_PARTS} select o_orderkey, part from read where regexp_full_match(part, '[0-9]{{4}}')")
def axis_years(spark, folder):
    """Four-digit words."""
    return ops.years(_labels(spark, folder)).select("o_orderkey", "part")


@query(
    f"""with {_PARTS} select o_orderstatus as axis, number as x,
    cast(arg_max(value, o_orderkey * 1000 + length(part)) as bigint) as v
    from read group by o_orderstatus, number"""
)
def axis_knots(spark, folder):
    """Axis map: the last label of a number wins."""
    parts = ops.label_parts(_labels(spark, folder)).withColumn(
        "at", F.col("o_orderkey") * 1000 + F.length("part")
    )
    return ops.axis_knots(parts, ["at"], axis="o_orderstatus").withColumnRenamed(
        "o_orderstatus", "axis"
    )


_MONTH_CASE = " ".join(
    f"when contains(line, '{m}') then '2022.{i:02d}'" for i, m in enumerate(MONTHS, 1)
)


@query(
    f"""select o_orderkey, case {_MONTH_CASE} end as month from (
    select o_orderkey, case when o_orderkey % 10 = 0 then 'n/a 7'
        else strftime(o_orderdate, '%d %b') end as line from orders)"""
)
def axis_months(spark, folder):
    """Month labels of a given year."""
    line = F.expr("case when o_orderkey % 10 = 0 then 'n/a 7' else date_format(o_orderdate, 'dd MMM') end")
    return v.table(spark, folder, "orders").select(
        "o_orderkey", month_label(line).alias("month")
    )
