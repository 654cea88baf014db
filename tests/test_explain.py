"""The plans that the operators should get."""

import pytest

from hitparade.plans import serving
from hitparade.operators.listing import page_key, sortable
from hitparade.plans.batch import DAYS
from hitparade.sinks.publication import Publication
from tests.conftest import SMALL
from workload.adapters import names
from workload.queries import QUERIES, listed


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def explain(spark, name):
    return plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["top_videos", "top_words", "wordcloud_documents", "trend_documents"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in explain(spark, name)


@pytest.mark.parametrize("name", ["listing_by_views", "listing_by_engagement", "listing_page", "scatter_points"])
def test_listings_sort_and_cut_together(spark, name):
    assert "TakeOrderedAndProject" in explain(spark, name)


def test_no_python_in_any_plan(spark):
    for name in ("ml_features", "word_counts", "url_video_id", "score_features", "listing_display", "quality_report"):
        text = explain(spark, name)
        assert "Python" not in text and "Pandas" not in text, name


def test_no_cross_joins(spark):
    for name in ("trend_documents", "category_share", "scatter_groups", "term_idf", "listing_named", "regression_metrics", "model_metrics"):
        text = explain(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def formatted(frame):
    return frame._jdf.queryExecution().explainString(frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_columns_and_filters_reach_the_stored_tables(spark, tmp_path):
    from workload.queries import documents

    documents(spark, SMALL).write.parquet(f"{tmp_path}/trending_results")
    listed = formatted(serving.trending(spark, str(tmp_path), country="ASIA", date="2017-03-01"))
    assert "EqualTo(country,ASIA)" in listed and "Or(EqualTo(date,2017-03-01),EqualTo(trending_date,2017-03-01))" in listed
    assert "total_views" not in listed
    assert "ReadSchema: struct<country:string>" in formatted(serving.countries(spark, str(tmp_path)))


@pytest.mark.parametrize("name", ["countries", "dates", "dates_of_both_generations"])
def test_no_set_of_a_whole_table_in_one_row(spark, name):
    assert "collect_set" not in explain(spark, name)


def test_category_share_reads_the_line_items_twice(spark):
    def scans(text):
        return sum("FileScan" in line and "/lineitem.parquet" in line for line in text.splitlines())

    spark.catalog.clearCache()  # the plan of what other tests have cached would be shown too
    assert scans(explain(spark, "category_share")) == 2
    assert scans(explain(spark, "scatter_groups")) == 2


def test_observations_are_not_dealt_out_anew(spark):
    for name in ("scan_observations", "trend_documents", "tfidf_description"):
        assert "REPARTITION" not in explain(spark, name)


def test_filters_reach_the_stored_observations(spark, tmp_path):
    from workload.adapters import cleaned

    with Publication(spark, str(tmp_path)) as new:
        new.write(cleaned(spark, SMALL).drop("l_orderkey", "l_linenumber"), "raw_videos", DAYS["raw_videos"])
    single = formatted(serving.group(spark, str(tmp_path), "ASIA", "2017-03-01"))
    chosen = next(line for line in single.splitlines() if "PartitionFilters" in line)
    assert "= ASIA" in chosen and "= 2017-03-01" in chosen


def test_the_key_of_a_page_reaches_the_stored_listing(spark, tmp_path):
    rows = sortable(listed(spark, SMALL), "engagement").selectExpr("*", "'x' AS processed_at")
    with Publication(spark, str(tmp_path)) as new:
        new.write(rows, "listed_videos")
        new.write(names(spark, SMALL), "category_names")
    key = page_key({**dict.fromkeys(rows.columns), "views": 90_000, "video_id": "v7"})
    text = formatted(serving.page_after(spark, str(tmp_path), key, country="ASIA"))
    assert "LessThanOrEqual(views,90000)" in text and "EqualTo(country,ASIA)" in text and "TakeOrderedAndProject" in text
