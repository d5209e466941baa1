"""Channel activity: search, newest and most-viewed video, active filter."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uttersieve.functions.times import age_days, parse_utc
from uttersieve.schema import CATEGORIES


def tag_categories(channels: DataFrame, categories=CATEGORIES, column="title") -> DataFrame:
    """One row per channel and category whose terms occur in ``column``.

    The categories are a short list of the job's settings: each is a predicate
    on the row, so there is no join.  ``"a|b"`` finds either word.
    """
    found = F.array_compact(
        F.array(*[F.when(F.col(column).rlike(f"(?i){c}"), F.lit(c)) for c in categories])
    )
    return channels.withColumn("category", F.explode(found))


def search(
    channels: DataFrame,
    categories=CATEGORIES,
    country=None,
    lang=None,
    column="title",
    most=50,
    order="channel_id",
) -> DataFrame:
    """At most ``most`` channels per category (a top-k report), by ``order``.

    Spark limits every task to ``most`` rows per category before the shuffle.
    """
    rows = channels
    if country is not None:
        rows = rows.filter(F.col("country") == country)
    if lang is not None:
        rows = rows.filter(F.col("lang") == lang)
    rank = F.row_number().over(Window.partitionBy("category").orderBy(order))
    return (
        tag_categories(rows, categories, column).withColumn("rank", rank).filter(F.col("rank") <= most)
    )


def _first_by(measure, *carried):
    """The row with the largest measure, ties to the smallest id: a minimum of
    ``(-measure, id, ...)``, so every task reduces its rows before the shuffle."""
    last = F.lit(float("inf"))
    return F.min(
        F.struct(F.coalesce(-measure.cast("double"), last).alias("by"), "video_id", *carried)
    )


def _newest():
    return _first_by(F.unix_seconds(parse_utc("published_at")), "published_at")


def _popular():
    return _first_by(F.col("views"), "views")


def newest_video(videos: DataFrame) -> DataFrame:
    """Newest video per channel; of several, the smallest id."""
    best = videos.groupBy("channel_id").agg(_newest().alias("_b"))
    return best.select("channel_id", "_b.video_id", "_b.published_at")


def popular_video(videos: DataFrame) -> DataFrame:
    """Most-viewed video per channel; of several, the smallest id."""
    best = videos.groupBy("channel_id").agg(_popular().alias("_b"))
    return best.select("channel_id", "_b.video_id", "_b.views")


def newest_and_popular(videos: DataFrame) -> DataFrame:
    """Both in one pass: ``channel_id, last_published, newest_id, popular_id``."""
    return (
        videos.groupBy("channel_id")
        .agg(_newest().alias("_n"), _popular().alias("_p"))
        .select(
            "channel_id",
            F.col("_n.published_at").alias("last_published"),
            F.col("_n.video_id").alias("newest_id"),
            F.col("_p.video_id").alias("popular_id"),
        )
    )


def active(channels: DataFrame, as_of, min_subs=100_000, max_age=30) -> DataFrame:
    """Channels with more subscribers than ``min_subs`` and a recent newest video."""
    age = age_days(as_of, parse_utc("last_published"))
    return channels.filter((F.col("subs") > min_subs) & (age <= max_age))


def video_link(video_id="popular_id"):
    return F.concat(F.lit("https://www.youtube.com/watch?v="), F.col(video_id).cast("string"))


def report(
    channels: DataFrame, videos: DataFrame, as_of, min_subs=100_000, max_age=30
) -> DataFrame:
    """Country, name, e-mail, genre and most-viewed video of the active channels.

    Small channels go first, and their videos with them, before any is reduced; a
    channel without videos drops out.
    """
    big = channels.filter(F.col("subs") > min_subs)
    theirs = videos.join(big.select("channel_id"), "channel_id", "left_semi")
    joined = big.join(newest_and_popular(theirs), "channel_id")
    return active(joined, as_of, min_subs, max_age).select(
        F.col("country").cast("string").alias("Country"),
        F.col("title").alias("Channel Name"),
        F.coalesce("email", F.lit("N/A")).alias("E-mail"),
        F.col("category").alias("Genre"),
        video_link().alias("Video Link"),
        "channel_id",
    )
