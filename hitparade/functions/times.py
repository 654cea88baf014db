"""Dates, times and ages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitparade import fixed


def trending_date(text: Column) -> Column:
    """Date of year.day.month text, null where it does not parse."""
    return F.try_to_date(text, fixed.TRENDING_DATE_FORMAT)


def publish_timestamp(text: Column) -> Column:
    """Clock time as written, null where it does not parse."""
    return F.try_to_timestamp(text, F.lit(fixed.PUBLISH_TIME_FORMAT))


def age_bucket(days: Column) -> Column:
    """1 to 4 for new to old; an unknown age counts as old."""
    newest, recent, older = fixed.AGE_BUCKET_DAYS
    return F.when(days <= newest, 1).when(days <= recent, 2).when(days <= older, 3).otherwise(4)


def result_date(date: Column) -> Column:
    return F.date_format(date, fixed.RESULT_DATE_FORMAT)


def processed_at(stamp: str | None = None) -> Column:
    """Time of processing as ISO text, the current time unless given."""
    if stamp is not None:
        return F.lit(stamp)
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def has_offset(text: Column) -> Column:
    """An offset ends the text, or stands before a last line end: within eight characters, so the rest is not searched."""
    return text.endswith("Z") | F.substring(text, -8, 8).rlike(r"(Z|[+-]\d\d:?\d\d)$")


def written_hour(text: Column) -> Column:
    """Hour as written in ISO text, whatever its offset; 0 for a bare date, null for other text."""
    character = lambda place: F.substring(text, place, 1)
    # In text that is a time, what stands between these are digits; only times in other shapes need the regular expression.
    full = (character(5) == "-") & (character(8) == "-") & character(11).isin("T", " ") & (character(14) == ":")
    hour = F.when(full, F.substring(text, 12, 2)).otherwise(F.regexp_extract(text, r"^\d{4}-\d\d-\d\d[T ](\d\d)", 1))
    return F.when(F.try_to_timestamp(text).isNotNull(), F.when(hour == "", 0).otherwise(hour.try_cast("int")))


def whole_days_between(earlier: Column, later: Column) -> Column:
    """Days from earlier to later, rounded down."""
    seconds = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(seconds / F.lit(86_400_000_000)).cast("int")
