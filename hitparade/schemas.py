"""Table schemas."""

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


RAW_SNAPSHOT = _fields(
    ("video_id", T.StringType()),
    ("trending_date", T.StringType()),
    ("title", T.StringType()),
    ("channel_title", T.StringType()),
    ("category_id", T.IntegerType()),
    ("publish_time", T.StringType()),
    ("tags", T.StringType()),
    ("views", T.LongType()),
    ("likes", T.LongType()),
    ("dislikes", T.LongType()),
    ("comment_count", T.LongType()),
    ("thumbnail_link", T.StringType()),
    ("comments_disabled", T.BooleanType()),
    ("ratings_disabled", T.BooleanType()),
    ("video_error_or_removed", T.BooleanType()),
    ("description", T.StringType()),
)

OBSERVATION = T.StructType([*RAW_SNAPSHOT.fields, T.StructField("country", T.StringType(), True)])

CATEGORY_FILE = _fields(
    (
        "items",
        T.ArrayType(_fields(("id", T.StringType()), ("snippet", _fields(("title", T.StringType()))))),
    ),
)

TOP_VIDEO = _fields(
    ("video_id", T.StringType()),
    ("title", T.StringType()),
    ("channel_title", T.StringType()),
    ("views", T.LongType()),
    ("likes", T.LongType()),
    ("dislikes", T.LongType()),
    ("comment_count", T.LongType()),
    ("category_id", T.IntegerType()),
    ("tags", T.StringType()),
)

TREND_DOCUMENT = _fields(
    ("country", T.StringType()),
    ("date", T.StringType()),
    ("processed_at", T.StringType()),
    (
        "statistics",
        _fields(
            ("total_videos", T.LongType()),
            ("total_views", T.LongType()),
            ("average_views", T.DoubleType()),
            ("max_views", T.LongType()),
            ("total_likes", T.LongType()),
            ("total_comments", T.LongType()),
        ),
    ),
    ("top_videos", T.ArrayType(TOP_VIDEO)),
)

WORD_DOCUMENT = _fields(
    ("country", T.StringType()),
    ("date", T.StringType()),
    ("processed_at", T.StringType()),
    ("words", T.ArrayType(_fields(("text", T.StringType()), ("value", T.LongType())))),
)

FEATURE_ROW = _fields(
    ("video_id", T.StringType()),
    ("country", T.StringType()),
    ("trending_date", T.StringType()),
    ("views", T.LongType()),
    ("likes", T.LongType()),
    ("dislikes", T.LongType()),
    ("comment_count", T.LongType()),
    ("category_id", T.IntegerType()),
    ("like_ratio", T.DoubleType()),
    ("dislike_ratio", T.DoubleType()),
    ("comment_ratio", T.DoubleType()),
    ("engagement_score", T.DoubleType()),
    ("title_length", T.IntegerType()),
    ("tag_count", T.IntegerType()),
    ("publish_hour", T.IntegerType()),
    ("publish_day_of_week", T.IntegerType()),
    ("video_age_days", T.IntegerType()),
    ("video_age_proxy", T.IntegerType()),
    ("log_views", T.DoubleType()),
    ("processed_at", T.StringType()),
)

CATEGORY_NAME = _fields(("country", T.StringType()), ("category_id", T.StringType()), ("category_name", T.StringType()))

LISTED_CATEGORY = _fields(("country", T.StringType()), ("category_id", T.IntegerType()))

COUNTRY_TOTALS = _fields(
    ("country", T.StringType()),
    ("total_videos", T.LongType()),
    ("max_views", T.LongType()),
    ("total_views", T.LongType()),
    ("total_likes", T.LongType()),
    ("total_comments", T.LongType()),
)

QUALITY_REPORT = _fields(("check", T.StringType()), ("column", T.StringType()), ("value", T.LongType()))

LISTED_VIDEO = T.StructType(
    [*TOP_VIDEO.fields, *_fields(("country", T.StringType()), ("date", T.StringType()), ("processed_at", T.StringType()), ("engagement", T.DoubleType())).fields]
)

DAY_TOTALS = T.StructType([COUNTRY_TOTALS["country"], T.StructField("date", T.StringType(), True), *COUNTRY_TOTALS.fields[1:]])

# Stored tables. Older trend documents carry trending_date instead of date.
TABLES = {
    "raw_videos": T.StructType([*OBSERVATION.fields, T.StructField("trending_date_parsed", T.StringType(), True)]),
    "trending_results": T.StructType([*TREND_DOCUMENT.fields, T.StructField("trending_date", T.StringType(), True)]),
    "wordcloud_data": WORD_DOCUMENT,
    "ml_features": FEATURE_ROW,
    "category_names": CATEGORY_NAME,
    "listed_categories": LISTED_CATEGORY,
    "country_totals": COUNTRY_TOTALS,
    "day_totals": DAY_TOTALS,
    "listed_videos": LISTED_VIDEO,
    "quality_report": QUALITY_REPORT,
}
