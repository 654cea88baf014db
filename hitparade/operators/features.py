"""Feature columns per observation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.numbers import engagement, log_plus_one, ratio
from hitparade.functions.texts import tag_count
from hitparade.functions.times import age_bucket, processed_at, publish_timestamp, result_date


def derived(observations: DataFrame) -> DataFrame:
    """Observations with time, engagement and text features, null where an input is missing."""
    views, likes, comments = F.col("views"), F.col("likes"), F.col("comment_count")
    return (
        observations.withColumn("published", publish_timestamp(F.col("publish_time")))
        .withColumns(
            {
                "publish_hour": F.hour("published"),
                "publish_day_of_week": F.dayofweek("published"),
                "video_age_days": F.datediff("trending_date_parsed", F.to_date("published")),
                "like_ratio": ratio(likes, views),
                "dislike_ratio": ratio(F.col("dislikes"), views),
                "comment_ratio": ratio(comments, views),
                "engagement_score": engagement(likes, comments, views),
                "title_length": F.length("title"),
                "tag_count": tag_count(F.col("tags"), empty_as_zero=False),
                "log_views": log_plus_one(views),
            }
        )
        .withColumn("video_age_proxy", age_bucket(F.col("video_age_days")))
        .drop("published")
    )


def ml_features(observations: DataFrame, stamp: str | None = None) -> DataFrame:
    """Feature rows with defaults for nulls."""
    filled = [
        F.coalesce(F.col(name), F.lit(default)).alias(name) for name, default in fixed.FEATURE_DEFAULTS.items()
    ]
    return derived(observations).select(
        "video_id",
        "country",
        result_date(F.col("trending_date_parsed")).alias("trending_date"),
        *filled,
        processed_at(stamp).alias("processed_at"),
    )
