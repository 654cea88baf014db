"""Questions to the stored results."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.operators import listing as op
from hitparade.operators.scoring import resolved_requests, score_both
from hitparade.operators.statistics import combined_statistics, table_counts
from hitparade.operators.training import feature_importance
from hitparade.operators.trends import trend_for
from hitparade.operators.words import listing_words, wordcloud
from hitparade.plans.batch import stored_observations
from hitparade.sources.results import load_models, read_table


def documents(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "trending_results")


def countries(spark: SparkSession, root: str) -> DataFrame:
    return op.countries(documents(spark, root))


def names(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "category_names")


def categories(spark: SparkSession, root: str, country: str | None = None) -> DataFrame:
    return op.categories(read_table(spark, root, "listed_categories"), names(spark, root), country)


def dates(spark: SparkSession, root: str, country: str | None = None) -> DataFrame:
    return op.dates(documents(spark, root), country)


def trending(spark: SparkSession, root: str, **arguments) -> DataFrame:
    return op.listing(documents(spark, root), **arguments)


def filtered(
    spark: SparkSession,
    root: str,
    country: str | None = None,
    category: str | int | None = None,
    date: str | None = None,
) -> DataFrame:
    """The listed videos that the questions below are about."""
    return op.listing_rows(documents(spark, root), country, category, date)


def page(spark: SparkSession, root: str, number: int, sort_by="views", order="desc", **filters) -> DataFrame:
    """One page of the listing, with category names."""
    return op.named(op.page(filtered(spark, root, **filters), number, sort_by, order), names(spark, root))


def page_after(spark: SparkSession, root: str, key: Mapping | None = None, sort_by="views", order="desc", country=None, category=None, date=None) -> DataFrame:
    """The page after the row with this key (listing.page_key), or the first one, from the stored listing."""
    rows = read_table(spark, root, "listed_videos")
    chosen = {"country": country or None, "category_id": None if category in (None, "") else int(category), "date": (date or "").strip() or None}
    for name, value in chosen.items():
        if value is not None:
            rows = rows.filter(F.col(name) == value)
    if (sort_by or "views").lower() != "engagement":
        rows = rows.drop("engagement")
    return op.named(op.page_after(rows, key, sort_by, order), names(spark, root))


def pages(spark: SparkSession, root: str, **filters) -> DataFrame:
    return op.page_count(filtered(spark, root, **filters))


def summary(spark: SparkSession, root: str, **filters) -> DataFrame:
    return op.summary(filtered(spark, root, **filters))


def category_share(spark: SparkSession, root: str, **filters) -> DataFrame:
    return op.category_share(filtered(spark, root, **filters), names(spark, root))


def title_words(spark: SparkSession, root: str, **filters) -> DataFrame:
    return listing_words(filtered(spark, root, **filters))


def scatter(spark: SparkSession, root: str, sort_by="views", order="desc", **filters) -> DataFrame:
    return op.scatter_groups(op.scatter_points(filtered(spark, root, **filters), sort_by, order), names(spark, root))


def group(spark: SparkSession, root: str, country: str, date: str) -> DataFrame:
    """The document of one country and date, worked out from its observations alone."""
    return trend_for(stored_observations(spark, root, country, date), country, date)


def country_statistics(spark: SparkSession, root: str, country: str | None = None) -> DataFrame:
    return combined_statistics(read_table(spark, root, "country_totals"), country)


def words(spark: SparkSession, root: str, country: str | None = None, date: str | None = None) -> DataFrame:
    return wordcloud(read_table(spark, root, "wordcloud_data"), country, date)


def sizes(spark: SparkSession, root: str) -> DataFrame:
    names = ("raw_videos", "trending_results", "wordcloud_data")
    return table_counts(**{name: read_table(spark, root, name) for name in names})


def predictions(requests: DataFrame, root: str) -> DataFrame:
    """Days and cluster for a table of requests, with the stored models."""
    models = load_models(root)
    return score_both(requests, models.get("days_regression"), models.get("clustering"))


def metadata_predictions(metadata: DataFrame, root: str, as_of: str) -> DataFrame:
    """Days and cluster for resolved video metadata (tag lists, ISO publish times), aged as of a time."""
    return predictions(resolved_requests(metadata, as_of), root)


def importance(root: str, n: int | None = None) -> DataFrame:
    """The features of the stored longevity model, the most important first."""
    return feature_importance(load_models(root, ("days_regression",))["days_regression"], n)


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """The metrics of the latest training."""
    return spark.read.json(f"{root}/metrics/latest")


def metrics_history(spark: SparkSession, root: str) -> DataFrame:
    """The metrics of every training, the latest first."""
    return spark.read.parquet(f"{root}/metrics/history").orderBy(F.col("training_timestamp").desc())
