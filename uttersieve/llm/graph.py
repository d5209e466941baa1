"""Connected components of a link table, as joins that end in the smallest label."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttersieve.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component_id`` for every node of ``edges``; the smallest node names it.

    Alternates two steps, written to the shared scratch folder, until every node hangs
    on its component's smallest one: every node's larger neighbours are hung on its smallest one,
    then the smaller ones are.  Both keep connectivity and shorten paths by half,
    so the rounds grow with the logarithm of the longest chain.  Rows are
    ``(node, node)`` only, a hub's list is aggregated on the map side first, and
    no list of neighbours is ever collected.
    """
    now = materialize(
        edges.select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
        ).filter("u <> v").distinct(),
        "links",
    )
    while not _settled(now):
        now = materialize(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionByName(roots).select(
        F.col("u").alias("node"), F.col("v").alias("component_id")
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    loose = ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not loose.filter("hangs > 1 or (hangs > 0 and holds > 0)").limit(1).count()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    least = least.select("k", F.least("k", "m").alias("m"))
    return (
        both.filter("v > u")
        .join(least, F.col("u") == F.col("k"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("k"))
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(moved.select("u", F.col("m").alias("v")))
        .filter("u <> v")
        .distinct()
    )


HOT_SHARE, HOT_ROWS = 1e-4, 1000  # of all rows, and at least


def look_up(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` left-joined to the other columns of ``table``, where ``key`` is unique and
    ``count`` tells how many rows have it.

    Keys with many rows are sent to the rows: at most ``1 / HOT_SHARE`` keys can each
    have more than ``HOT_SHARE`` of all rows, however large the table is.  No
    other key can fill a task.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    often = F.col(count) > max(total * HOT_SHARE, HOT_ROWS)
    hot = F.broadcast(table.filter(often).drop(count))
    rest = rows.join(hot.select(key), key, "left_anti").join(
        table.filter(~often).drop(count), key, "left"
    )
    return rows.join(hot, key).unionByName(rest)
