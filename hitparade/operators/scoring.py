"""Scoring of tables of videos."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.numbers import clamp
from hitparade.functions.texts import tag_count
from hitparade.functions.times import age_bucket, has_offset, whole_days_between, written_hour
from hitparade.operators.forest import predicted
from hitparade.operators.lookups import cluster_name


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Requests with every field; missing columns and nulls take the field's default."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(default)) if name in requests.columns else F.lit(default)
        for name, default in fixed.REQUEST_DEFAULTS.items()
    }
    return requests.withColumns(filled)


def resolved_requests(metadata: DataFrame, as_of: str) -> DataFrame:
    """Requests from video metadata with a tag list and an ISO publish time, aged as of a given time."""
    published = F.col("published_at")
    stamp = F.try_to_timestamp(published)
    days = whole_days_between(stamp, F.lit(as_of).cast("timestamp"))
    tags = F.coalesce(F.col("tag_list"), F.array().cast("array<string>"))
    known_age = stamp.isNotNull() & has_offset(published)
    return with_request_defaults(
        metadata.withColumns(
            {
                "tags": F.array_join(tags, "|"),
                "has_tags": F.size(tags) > 0,
                "description_length": F.length(F.coalesce("description", F.lit(""))),
                "publish_hour": written_hour(published),
                "video_age_proxy": F.when(known_age, age_bucket(days)),
            }
        )
    )


def _at_least_one(views: Column) -> Column:
    return F.greatest(views.cast("double"), F.lit(1.0))


def model_inputs(requests: DataFrame, names) -> DataFrame:
    """(request, inputs...): the requests as given, and the named model inputs as doubles."""
    field = {name: F.col(f"request.{name}") for name in ("title", *fixed.REQUEST_DEFAULTS)}
    views = _at_least_one(field["views"])
    likes, comments = field["likes"].cast("double"), field["comment_count"].cast("double")
    inputs = {
        "views": views,
        "likes": likes,
        "comment_count": comments,
        "like_ratio": likes / views,
        "engagement_score": (likes + comments) / views,
        "title_length": F.length(field["title"]).cast("double"),
        "tag_count": tag_count(field["tags"], empty_as_zero=True).cast("double"),
        "category_id": field["category_id"].cast("double"),
        "publish_hour": field["publish_hour"].cast("double"),
        "video_age_proxy": field["video_age_proxy"].cast("double"),
        "log_views": F.log1p(views),
        "log_likes": F.log1p(likes),
        "log_comments": F.log1p(comments),
    }
    packed = with_request_defaults(requests).select(F.struct("*").alias("request"))
    return packed.select("request", *[inputs[name].alias(name) for name in names])


def heuristic_days(requests: DataFrame) -> DataFrame:
    """Requests with a longevity estimate from scale and engagement."""
    full = with_request_defaults(requests)
    views = _at_least_one(F.col("views"))
    share = (F.col("likes") + F.col("comment_count")) / views
    score = F.log1p(views) * (share + fixed.HEURISTIC_BASE)
    return full.withColumns(
        {
            "predicted_days": F.round(clamp(score, 0.0, fixed.HEURISTIC_MAX_DAYS), 2),
            "confidence": F.lit("medium"),
            "days_method": F.lit("heuristic"),
        }
    )


def score_days(requests: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Requests with predicted days in trending, by the model, from the inputs that it was fitted on, or else by the heuristic."""
    if model is None:
        return heuristic_days(requests)
    scaled = PipelineModel(model.stages[:-1]).transform(model_inputs(requests, model.stages[0].getInputCols()))
    return predicted(model.stages[-1], scaled).select(
        "request.*",
        F.round(F.greatest(F.col("prediction"), F.lit(0.0)), 2).alias("predicted_days"),
        F.lit("high").alias("confidence"),
        F.lit("spark_mllib").alias("days_method"),
    )


def score_cluster(requests: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Requests with their cluster and its name."""
    if model is None:
        raise ValueError("no clustering model")
    scored = model.transform(model_inputs(requests, fixed.CLUSTER_FEATURES))
    return scored.select(
        "request.*",
        "cluster",
        cluster_name(F.col("cluster")).alias("cluster_type"),
        F.lit("spark_mllib").alias("cluster_method"),
    )


def score_both(
    requests: DataFrame, days_model: PipelineModel | None, cluster_model: PipelineModel | None
) -> DataFrame:
    """Requests with predicted days and cluster."""
    return score_cluster(score_days(requests, days_model), cluster_model)
