import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from hitparade.functions import numbers, texts, times


def apply(spark, column, kind, *values):
    rows = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, c {kind}")
    return [r.out for r in rows.select("i", column(F.col("c")).alias("out")).orderBy("i").collect()]


def exact(value: float) -> str:
    return str(Decimal(value).quantize(Decimal("0.1"), ROUND_HALF_UP))


def test_one_decimal_rounds_the_binary_value_with_ties_up(spark):
    rnd = random.Random(5)
    values = [0.0, 12.25, 12.75, 1.15, 0.35, 1.05, 0.3, 99.95, 999.95, 1.25, 2.5, 0.05, 0.15, 0.25, 1e6 + 0.05]
    values += [n / 1000 for n in range(1050, 40000, 100)] + [n / 1e6 for n in range(1_050_000, 9_999_999, 100_000)]
    values += [rnd.uniform(0, 1000) for _ in range(500)] + [rnd.uniform(0, 1e8) for _ in range(200)]
    assert apply(spark, numbers.one_decimal, "double", *values) == [exact(v) for v in values]


def test_compact_and_percent(spark):
    found = apply(spark, numbers.compact, "bigint", 0, 999, 1000, 1150, 12250, 999949, 999950, 1000000, 1234567, None, -5)
    assert found == ["0", "999", "1.0K", "1.1K", "12.3K", "999.9K", "1000.0K", "1.0M", "1.2M", "0", "-5"]
    assert apply(spark, numbers.percent, "double", 0.1234, 0.0, 1.0) == ["12.3%", "0.0%", "100.0%"]


def test_clamping_keeps_nulls(spark):
    assert apply(spark, numbers.clamp_negative, "bigint", -5, 0, 7, None) == [0, 0, 7, None]
    assert apply(spark, numbers.nan_to_null, "double", float("nan"), 1.0, None) == [None, 1.0, None]


def test_dates(spark):
    assert [str(d) for d in apply(spark, times.trending_date, "string", "17.14.11", "bad", None)] == ["2017-11-14", "None", "None"]
    found = apply(spark, lambda c: F.hour(times.publish_timestamp(c)), "string", "2017-11-13T17:13:01.000Z", "x", "2017-11-13T17:13:01Z")
    assert found == [17, None, None]


def test_age_buckets(spark):
    assert apply(spark, times.age_bucket, "int", -4, 1, 2, 7, 8, 30, 31, None) == [1, 1, 2, 2, 3, 3, 4, 4]


def test_hours_as_written(spark):
    values = ["2017-11-13T17:13:01Z", "2017-11-13T17:13:01+05:30", "2017-11-13T05:13:01.123Z", "2017-11-13", "no date", None]
    assert apply(spark, times.written_hour, "string", *values) == [17, 17, 5, 0, None, None]
    assert apply(spark, times.has_offset, "string", *values) == [True, True, True, False, False, None]


def test_hours_and_offsets_of_odd_texts(spark):
    """As regular expressions over the whole text give them, which common texts do without."""
    dates = ["2017-11-13", "2017-1-3", " 2017-11-13", "+2017-11-13", "02017-11-13", "2017-11", "2017", "17-11-13", "２017-11-13"]
    clocks = ["T17:13:01", " 07:13:01", "T7:13", "T17", "T7", "T5 ", " ", "  ", "T 5:13", "T24:00:00", "T17:13:01.5", "T17:1:1", "TT7:13", "T:13:01", ""]
    ends = ["", "Z", "Z\n", "+02:00", "+0200\r\n", "-05:30\n", " Z", "+02", "Z\n\n", "UTC", "\u2028", "+02:00\u2028", "😀+02:00"]
    texts_ = [date + clock + end for date in dates for clock in clocks for end in ends] + ["Z", "+0200", "T17:13:01", "17:13:01Z", "", None]
    rows = spark.createDataFrame([(text,) for text in texts_], "c string")
    hour = F.regexp_extract("c", r"^\d{4}-\d\d-\d\d[T ](\d\d)", 1)
    plain = F.when(F.try_to_timestamp("c").isNotNull(), F.when(hour == "", 0).otherwise(hour.try_cast("int")))
    found = rows.select("c", times.written_hour(F.col("c")).alias("hour"), plain.alias("hour_"))
    found = found.withColumns({"offset": times.has_offset(F.col("c")), "offset_": F.col("c").rlike(r"(Z|[+-]\d\d:?\d\d)$")})
    assert found.where("hour is not null").count() > 50 and found.where("offset").count() > 500
    assert found.where(~F.col("hour").eqNullSafe(F.col("hour_")) | ~F.col("offset").eqNullSafe(F.col("offset_"))).collect() == []
    plan = spark._jvm.PythonSQLUtils.explainString(found.select("hour", "offset")._jdf.queryExecution(), "simple")
    assert "RLIKE(c#" not in plan and "CASE WHEN" in plan.split("regexp_extract(c#")[0]


def test_tag_counts(spark):
    values = ["", "[none]", "a|b", None]
    assert apply(spark, lambda c: texts.tag_count(c, empty_as_zero=False), "string", *values) == [1, 1, 2, 0]
    assert apply(spark, lambda c: texts.tag_count(c, empty_as_zero=True), "string", *values) == [0, 1, 2, 0]


def test_title_length_counts_characters(spark):
    assert apply(spark, F.length, "string", "a😀b") == [3]


def test_links(spark):
    cases = {
        "https://www.youtube.com/watch?v=abc&t=1": "abc",
        "https://www.youtube.com/watch?list=x&v=a%20b#top": "a b",
        "https://www.youtube.com/watch?v=&v=z": "z",
        "https://youtu.be/xyz": "xyz",
        "https://youtu.be/xyz?t=3": "xyz",
        "https://youtu.be/": None,
        "https://m.youtube.com/embed/qq?x=1": "qq",
        "https://www.youtube.com/embed/": None,
        "https://www.youtube.com/": None,
        "https://other.org/watch?v=1": None,
        "not a url": None,
        "http://notyoutube.com/watch?v=z": "z",
        None: None,
    }
    assert apply(spark, texts.link_video_id, "string", *cases) == list(cases.values())
    assert apply(spark, texts.watch_link, "string", "a", "", None) == ["https://www.youtube.com/watch?v=a", None, None]
