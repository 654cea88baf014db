"""Statistics and top videos per country and day."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.numbers import zero_if_null
from hitparade.functions.times import processed_at, result_date
from hitparade.schemas import TOP_VIDEO

GROUP = ("country", "trending_date_parsed")


def dated(observations: DataFrame) -> DataFrame:
    return observations.filter(F.col("trending_date_parsed").isNotNull())


def trend_groups(observations: DataFrame) -> DataFrame:
    return observations.select(*GROUP).distinct()


def trend_stats(observations: DataFrame) -> DataFrame:
    return (
        dated(observations)
        .groupBy(*GROUP)
        .agg(
            F.count("*").alias("total_videos"),
            zero_if_null(F.sum("views")).alias("total_views"),
            F.coalesce(F.avg("views"), F.lit(0.0)).alias("average_views"),
            zero_if_null(F.max("views")).alias("max_views"),
            zero_if_null(F.sum("likes")).alias("total_likes"),
            zero_if_null(F.sum("comment_count")).alias("total_comments"),
        )
    )


def top_videos(observations: DataFrame, k: int = fixed.TOP_VIDEOS) -> DataFrame:
    """The k most viewed rows of each group, ranked; equal views go by video id, then by the other columns.

    Each input partition passes on at most k rows per group, so a hot group stays small after the scan.
    """
    others = [F.col(name).asc_nulls_first() for name in TOP_VIDEO.names if name != "views"]
    order = Window.partitionBy(*GROUP).orderBy(F.col("views").desc_nulls_last(), *others)
    counters = {name: zero_if_null(F.col(name)) for name in fixed.COUNTER_COLUMNS}
    return (
        dated(observations)
        .select(*GROUP, *TOP_VIDEO.names)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .withColumns(counters)
    )


def trend_documents(observations: DataFrame, k: int = fixed.TOP_VIDEOS, stamp: str | None = None) -> DataFrame:
    """One nested document per group; lists hold at most k videos, in rank order."""
    lists = (
        top_videos(observations, k)
        .groupBy(*GROUP)
        .agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*TOP_VIDEO.names).alias("video")))).alias("ranked"))
    )
    statistics = [name for name in trend_stats(observations).columns if name not in GROUP]
    return (
        trend_stats(observations)
        .join(lists, list(GROUP))
        .select(
            "country",
            result_date(F.col("trending_date_parsed")).alias("date"),
            processed_at(stamp).alias("processed_at"),
            F.struct(*statistics).alias("statistics"),
            F.col("ranked.video").alias("top_videos"),
        )
    )


def trend_for(observations: DataFrame, country: str, date: str, k: int = fixed.TOP_VIDEOS) -> DataFrame:
    """The document of one group."""
    group = (F.col("country") == country) & (F.col("trending_date_parsed") == F.lit(date).cast("date"))
    return trend_documents(observations.filter(group), k)


def flattened(documents: DataFrame) -> DataFrame:
    """Documents as one row per listed video, with position and statistics."""
    return documents.select(
        "country", "date", "statistics.*", F.posexplode("top_videos").alias("position", "video")
    ).select("*", "video.*").drop("video")
