"""Ratios, clamps, logarithms and numbers as display text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, views: Column) -> Column:
    """part / views, 0 where views is not positive; a null part stays null."""
    return F.when(views > 0, part / views).otherwise(F.lit(0.0))


def engagement(likes: Column, comments: Column, views: Column) -> Column:
    return ratio(likes + comments, views)


def engagement_or_zero(likes: Column, comments: Column, views: Column) -> Column:
    """Engagement that counts missing likes and comments as 0."""
    return engagement(zero_if_null(likes), zero_if_null(comments), views)


def zero_if_null(number: Column) -> Column:
    return F.coalesce(number, F.lit(0))


def clamp_negative(number: Column) -> Column:
    """Negatives become 0, nulls stay null."""
    return F.when(number < 0, F.lit(0)).otherwise(number)


def clamp(number: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), number))


def log_plus_one(number: Column) -> Column:
    return F.log(number + 1)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def one_decimal(number: Column) -> Column:
    """Text with one decimal, rounded on the exact binary value, ties up; for 0 <= number < 2**28."""
    tenths = F.floor(number * 10)
    # Compare with the tie point (2 * tenths + 1) / 20 without rounding: both halves times 20 are exact.
    high = F.floor(number * 2**20) / F.lit(float(2**20))
    above = ((high * 20 - (tenths * 2 + 1)) + (number - high) * 20) >= 0
    rounded = tenths + above.cast("bigint")
    return F.concat(F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"))


def compact(number: Column) -> Column:
    """1234567 as 1.2M, 12345 as 12.3K, smaller numbers in full, null as 0."""
    return (
        F.when(number >= 1_000_000, F.concat(one_decimal(number / 1_000_000), F.lit("M")))
        .when(number >= 1_000, F.concat(one_decimal(number / 1_000), F.lit("K")))
        .otherwise(F.coalesce(number.cast("string"), F.lit("0")))
    )


def percent(share: Column) -> Column:
    """0.1234 as 12.3%."""
    return F.concat(one_decimal(share * 100), F.lit("%"))
