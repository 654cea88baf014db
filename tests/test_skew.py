"""One group with a third of all rows and more: whole and right results, small shuffles."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hitparade.operators import cleaning, training, trends, words

ROWS = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one country and day, and four in ten of one video."""
    n = F.col("id")
    hot = n % 2 == 0
    return (
        spark.range(ROWS, numPartitions=16)
        .select(
            F.when(n % 5 < 2, "hot").otherwise(F.concat(F.lit("v"), (n % 997).cast("string"))).alias("video_id"),
            F.when(hot, "US").otherwise(F.concat(F.lit("C"), (n % 7).cast("string"))).alias("country"),
            F.when(hot, F.lit("2018-01-01")).otherwise(F.lit("2018-01-02")).cast("date").alias("trending_date_parsed"),
            F.concat_ws(" ", F.lit("song"), F.concat(F.lit("word"), (n % 83).cast("string"))).alias("title"),
            F.lit("ch").alias("channel_title"),
            (n * 7919 % 100_003).alias("views"),
            (n % 11).alias("likes"),
            F.lit(0).cast("bigint").alias("dislikes"),
            (n % 13).alias("comment_count"),
            (n % 40).cast("int").alias("category_id"),
            F.lit("").alias("tags"),
        )
        .cache()
    )


def test_top_videos(spark, skewed):
    rows = sorted(skewed.collect(), key=lambda r: (r.country, r.trending_date_parsed, -r.views, r.video_id, r.likes))
    expected, taken = [], Counter()
    for row in rows:
        taken[row.country] += 1
        if taken[row.country] <= 10:
            expected.append((row.country, taken[row.country], row.video_id, row.views))
    found = trends.top_videos(skewed).select("country", "rank", "video_id", "views").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_a_hot_group_is_cut_before_the_shuffle(spark, skewed):
    top = trends.top_videos(skewed)
    top.collect()
    written = _shuffled_rows(top)
    groups = trends.trend_groups(skewed).count()
    assert 0 < written <= 16 * 10 * groups < ROWS / 20


def _shuffled_rows(frame):
    """Rows written by the exchanges of a finished query, from its metrics."""
    gateway = frame._sc._jvm
    todo, total = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = gateway.scala.jdk.javaapi.CollectionConverters.asJava(node.children())
        todo.extend(children)
    return total


def test_counts(skewed):
    days = {r.video_id: r.days_in_trending for r in training.longevity_label(_features(skewed)).collect()}
    assert days == Counter(r.video_id for r in skewed.select("video_id").collect())
    assert days["hot"] == ROWS * 2 // 5
    counted = words.word_counts(skewed).groupBy("word").agg(F.sum("value").alias("n"))
    expected = Counter(word for r in skewed.select("title").collect() for word in r.title.split())
    assert {r.word: r.n for r in counted.collect()} == expected
    assert cleaning.duplicate_keys(skewed).first()[0] == sum(n > 1 for n in days.values())


def _features(rows):
    extra = {name: F.lit(1) for name in ("title_length", "tag_count", "publish_hour", "video_age_proxy")}
    return rows.withColumns(extra)
