"""Schema checks, quality report and cleaning."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.numbers import clamp_negative
from hitparade.schemas import OBSERVATION


def require_columns(rows: DataFrame) -> None:
    missing = sorted(set(OBSERVATION.names) - set(rows.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def type_mismatches(rows: DataFrame) -> DataFrame:
    """(column, found, expected) for the columns of another type than expected."""
    require_columns(rows)
    found = [
        (field.name, rows.schema[field.name].dataType.simpleString(), field.dataType.simpleString())
        for field in OBSERVATION.fields
        if rows.schema[field.name].dataType != field.dataType
    ]
    spark: SparkSession = rows.sparkSession
    return spark.createDataFrame(found, "column string, found string, expected string")


def clean(rows: DataFrame) -> DataFrame:
    """Rows with id and title; negative counters as 0; defaults for missing text."""
    kept = rows.filter(F.col("video_id").isNotNull() & F.col("title").isNotNull())
    clamped = kept.withColumns({name: clamp_negative(F.col(name)) for name in fixed.COUNTER_COLUMNS})
    return clamped.na.fill({name: value for name, value in fixed.CLEAN_DEFAULTS.items() if name in rows.columns})


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """The number of video ids with more than one row."""
    per_video = rows.groupBy("video_id").agg(F.count("*").alias("n"))
    return per_video.agg(F.count_if(F.col("n") > 1).alias("duplicate_video_ids"))


def quality_counts() -> dict[str, Column]:
    """Aggregates for rows, nulls in critical columns and negative counters."""
    nulls = {f"null_{name}": F.count_if(F.col(name).isNull()) for name in fixed.CRITICAL_COLUMNS}
    negatives = {f"negative_{name}": F.count_if(F.col(name) < 0) for name in fixed.COUNTER_COLUMNS}
    return {"total_rows": F.count("*"), **nulls, **negatives}


REPORT = (
    [("total_rows", None, "total_rows")]
    + [("null_count", name, f"null_{name}") for name in fixed.CRITICAL_COLUMNS]
    + [("negative_count", name, f"negative_{name}") for name in fixed.COUNTER_COLUMNS]
    + [("duplicate_video_ids", "video_id", "duplicate_video_ids")]
)


def quality_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """(check, column, value) from counts taken elsewhere."""
    rows = [(check, column, counts[name]) for check, column, name in REPORT]
    return spark.createDataFrame(rows, "check string, column string, value bigint")


def quality_report(rows: DataFrame) -> DataFrame:
    """(check, column, value): rows, nulls, negatives and repeated video ids, from one scan.

    Counts are taken per video first, which gives the repeats on the way to the totals.
    """
    counts = quality_counts()
    per_video = rows.groupBy("video_id").agg(*[column.alias(name) for name, column in counts.items()])
    totals = per_video.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        F.count_if(F.col("total_rows") > 1).alias("duplicate_video_ids"),
    )
    entries = [
        F.struct(
            F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"), F.col(name).alias("value")
        )
        for check, column, name in REPORT
    ]
    return totals.select(F.inline(F.array(*entries)))
