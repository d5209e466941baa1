"""Nested channel and video records, flattened by projection."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttersieve.functions.numbers import to_long
from uttersieve.schema import CHANNEL_DETAILS, VIDEO_ITEM


def channel_details(spark: SparkSession, path: str) -> DataFrame:
    return flat_channels(spark.read.schema(CHANNEL_DETAILS).json(path))


def video_items(spark: SparkSession, path: str) -> DataFrame:
    return flat_videos(spark.read.schema(VIDEO_ITEM).json(path))


def flat_channels(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("channel_id"),
        F.col("snippet.title").alias("title"),
        F.col("snippet.email").alias("email"),
        F.col("snippet.country").alias("country"),
        F.col("snippet.lang").alias("lang"),
        to_long("statistics.subscriberCount").alias("subs"),
    )


def flat_videos(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("snippet.channelId").alias("channel_id"),
        F.col("id.videoId").alias("video_id"),
        F.col("snippet.publishedAt").alias("published_at"),
        to_long("statistics.viewCount").alias("views"),
    )
