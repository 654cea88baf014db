"""Every registered query: a function from (spark, sf_dir) to a DataFrame."""

from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.texts import link_video_id
from hitparade.operators import cleaning, features, listing, lookups, scoring, statistics, training, trends, words
from hitparade.plans import serving
from hitparade.plans.batch import run_batch, run_days
from hitparade.plans.training import Trained, inputs, train
from hitparade.schemas import RAW_SNAPSHOT
from hitparade.session import cut_lineage, scratch, scratch_folder
from hitparade.sinks.tables import normalised, save_model, write_metrics
from hitparade.sources import results, snapshots
from hitparade.sources.categories import read_categories
from workload import adapters as a

QUERIES = {}

# Arguments of the queries that ask for one country, day, category, page or point in time.
COUNTRY = "ASIA"
DATE = "2017-03-01"
CATEGORY = 7
PAGE = 3
AS_OF = "2018-01-01T00:00:00Z"


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(rows: DataFrame, digits: int, *names) -> DataFrame:
    """Logarithms and sums of fractions differ in their last bits between engines."""
    return rows.withColumns({name: F.round(name, digits) for name in names})


# Loading and cleaning


@query
def scan_observations(spark, sf_dir):
    return a.observations(spark, sf_dir)


@query
def load_observations(spark, sf_dir):
    return a.loaded(spark, sf_dir)


@query
def clean_observations(spark, sf_dir):
    return a.cleaned(spark, sf_dir)


@query
def union_sources(spark, sf_dir):
    videos = a.loaded(spark, sf_dir).select("country", "trending_date_parsed", "video_id", "views")
    events = a.daily_snapshots(spark, sf_dir).select("views", "video_id", "trending_date_parsed", "country")
    return snapshots.union_sources(videos, events)


@query
def raw_normalised(spark, sf_dir):
    rating = F.when(F.col("l_orderkey") % 73 == 0, F.lit(float("nan"))).otherwise(F.col("l_linenumber").cast("double"))
    return normalised(a.cleaned(spark, sf_dir).withColumn("rating", rating))


@query
def category_dim(spark, sf_dir):
    return a.names(spark, sf_dir)


@query
def csv_round_trip(spark, sf_dir):
    """Observations with awkward texts, written as CSV files and read as the batch reads them; empty texts come back as nulls."""
    with scratch_folder(spark) as folder, scratch(spark) as cut:
        pattern = a.write_csv(a.awkward(a.observations(spark, sf_dir)).select(*RAW_SNAPSHOT.names, "country"), folder)
        return cut_lineage(snapshots.read_snapshots(spark, pattern, cut))


@query
def category_round_trip(spark, sf_dir):
    """Dictionaries written as JSON files and read as the batch reads them."""
    with scratch_folder(spark) as folder:
        return cut_lineage(read_categories(spark, a.write_category_files(a.category_files(spark, sf_dir), folder)))


@query
def batch_by_days(spark, sf_dir):
    """Totals of each country and day, after a first load of early years and a second one of later years and of one anew."""
    rows = a.observations(spark, sf_dir).select(*RAW_SNAPSHOT.names, "country")
    year = F.substring("trending_date", 1, 2).cast("int")
    with scratch_folder(spark) as folder:
        root = f"{folder}/tables"
        with scratch_folder(spark) as files:
            run_batch(spark, a.write_csv(rows.where(year < 16), files), root)
        later = rows.where(year >= 15).withColumn("views", F.col("views") + 1)
        with scratch_folder(spark) as files:
            run_days(spark, a.write_csv(later, files), root)
        return cut_lineage(results.read_table(spark, root, "day_totals"))


@query
def quality_report(spark, sf_dir):
    return cleaning.quality_report(a.loaded(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    return cleaning.duplicate_keys(a.loaded(spark, sf_dir))


# Trends


@query
def top_videos(spark, sf_dir):
    return trends.top_videos(a.cleaned(spark, sf_dir))


@query
def trend_stats(spark, sf_dir):
    return trends.trend_stats(a.cleaned(spark, sf_dir))


@query
def trend_stats_daily(spark, sf_dir):
    return trends.trend_stats(a.daily_snapshots(spark, sf_dir))


@query
def trend_groups(spark, sf_dir):
    return trends.trend_groups(a.cleaned(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.trend_documents(a.cleaned(spark, sf_dir))


@query
def trend_documents(spark, sf_dir):
    return trends.flattened(documents(spark, sf_dir))


@query
def trend_for_group(spark, sf_dir):
    return trends.flattened(trends.trend_for(a.cleaned(spark, sf_dir), COUNTRY, DATE))


# Words


@query
def word_counts(spark, sf_dir):
    return words.word_counts(a.title_rows(spark, sf_dir))


@query
def top_words(spark, sf_dir):
    return words.top_words(a.title_rows(spark, sf_dir))


def word_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.wordcloud_documents(a.cleaned(spark, sf_dir))


def _listed_words(rows: DataFrame) -> DataFrame:
    listed = rows.select("country", "date", F.posexplode("words").alias("position", "word"))
    return listed.select("country", "date", "position", "word.*")


@query
def wordcloud_documents(spark, sf_dir):
    return _listed_words(word_documents(spark, sf_dir))


@query
def wordcloud_latest(spark, sf_dir):
    return _listed_words(words.wordcloud(word_documents(spark, sf_dir)))


# Listings


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.listing_rows(documents(spark, sf_dir)).drop("processed_at")


def _listing(spark, sf_dir, **arguments):
    return listing.listing(documents(spark, sf_dir), **arguments).drop("processed_at")


@query
def listing_flat(spark, sf_dir):
    return listed(spark, sf_dir)


@query
def listing_filtered(spark, sf_dir):
    return _listing(spark, sf_dir, country=COUNTRY, category=CATEGORY)


@query
def listing_for_date(spark, sf_dir):
    return _listing(spark, sf_dir, date=DATE, sort_by="unknown key", order="ASC")


@query
def listing_by_views(spark, sf_dir):
    return _listing(spark, sf_dir)


@query
def listing_by_likes(spark, sf_dir):
    return _listing(spark, sf_dir, sort_by="likes")


@query
def listing_by_comments(spark, sf_dir):
    return _listing(spark, sf_dir, sort_by="comments", order="asc", limit=1000)


@query
def listing_by_engagement(spark, sf_dir):
    return _listing(spark, sf_dir, sort_by="engagement")


@query
def listing_page(spark, sf_dir):
    return listing.page(listed(spark, sf_dir), PAGE)


@query
def listing_page_by_key(spark, sf_dir):
    """The page after the last row of the page before, with a stored listing."""
    rows = cut_lineage(listed(spark, sf_dir))
    last = listing.page(rows, PAGE - 1).tail(1)[0]
    return listing.page_after(rows, listing.page_key(last))


@query
def listing_pages(spark, sf_dir):
    return listing.page_count(listed(spark, sf_dir))


@query
def listing_named(spark, sf_dir):
    return listing.named(listed(spark, sf_dir), a.names(spark, sf_dir))


@query
def listing_display(spark, sf_dir):
    return listing.display(listed(spark, sf_dir))


@query
def listing_summary(spark, sf_dir):
    return rounded(listing.summary(listed(spark, sf_dir)), 9, "mean_engagement")


@query
def listing_words(spark, sf_dir):
    return words.listing_words(listed(spark, sf_dir))


@query
def countries(spark, sf_dir):
    return listing.countries(documents(spark, sf_dir))


@query
def categories(spark, sf_dir):
    return listing.categories(listing.listed_categories(documents(spark, sf_dir)), a.names(spark, sf_dir))


@query
def dates(spark, sf_dir):
    return listing.dates(documents(spark, sf_dir))


@query
def dates_of_both_generations(spark, sf_dir):
    """Half of the documents with their date under the older name, some with both and some with a blank."""
    number = F.dayofmonth("date") + F.month("date")
    older = F.when(number % 3 != 0, F.concat(F.substring("date", 1, 8), F.lit("28")))
    newer = F.when(number % 2 == 0, F.col("date")).when(number % 5 == 0, "")
    both = documents(spark, sf_dir).withColumns({"trending_date": older, "date": newer})
    return listing.dates(both)


@query
def category_share(spark, sf_dir):
    return listing.category_share(listed(spark, sf_dir), a.names(spark, sf_dir))


@query
def scatter_points(spark, sf_dir):
    return listing.scatter_points(listed(spark, sf_dir))


@query
def scatter_groups(spark, sf_dir):
    points = listing.scatter_points(listed(spark, sf_dir))
    return listing.scatter_groups(points, a.names(spark, sf_dir))


# Statistics


@query
def statistics_all(spark, sf_dir):
    return statistics.statistics(a.cleaned(spark, sf_dir))


@query
def statistics_country(spark, sf_dir):
    return statistics.statistics(a.cleaned(spark, sf_dir), COUNTRY)


@query
def table_counts(spark, sf_dir):
    return statistics.table_counts(
        raw_videos=a.cleaned(spark, sf_dir),
        trending_results=documents(spark, sf_dir),
        wordcloud_data=word_documents(spark, sf_dir),
    )


@query
def category_distribution(spark, sf_dir):
    return statistics.category_distribution(feature_rows(spark, sf_dir))


@query
def text_presence(spark, sf_dir):
    return statistics.text_presence(a.cleaned(spark, sf_dir))


@query
def training_gate(spark, sf_dir):
    return statistics.training_gate(feature_rows(spark, sf_dir))


# Features


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.ml_features(a.cleaned(spark, sf_dir))


@query
def ml_features(spark, sf_dir):
    return rounded(feature_rows(spark, sf_dir).drop("processed_at"), 9, "log_views")


@query
def training_input(spark, sf_dir):
    columns = ["video_id", "country", "trending_date", "channel_title", "tags", "views", "likes", "dislikes"]
    return results.training_input(a.loaded(spark, sf_dir).select(*columns, "comment_count", "category_id"))


@query
def cluster_features(spark, sf_dir):
    rows = training.cluster_features(feature_rows(spark, sf_dir))
    return rounded(rows, 9, "log_views", "log_likes", "log_comments")


@query
def model_defaults(spark, sf_dir):
    """Features of an older table, which lacks the publish hour and the age bucket."""
    older = feature_rows(spark, sf_dir).drop("publish_hour", "video_age_proxy")
    rows = training.with_model_defaults(older)
    return rows.select("video_id", "country", "trending_date", "engagement_score", "publish_hour", "video_age_proxy")


@query
def weights_without_text(spark, sf_dir):
    """Rows without a description column, and rows with blank ones only, weigh nothing."""
    rows = a.cleaned(spark, sf_dir).select("video_id", "country", "trending_date")
    blank = rows.withColumn("description", F.when(F.col("country") == COUNTRY, ""))
    return snapshots.union_sources(training.description_weights(rows), training.description_weights(blank).drop("description"))


@query
def longevity_label(spark, sf_dir):
    return training.longevity_label(feature_rows(spark, sf_dir))


@query
def longevity_features(spark, sf_dir):
    return training.longevity_features(feature_rows(spark, sf_dir))


@query
def scaled_features(spark, sf_dir):
    rows = training.scaled(cut_lineage(training.cluster_features(feature_rows(spark, sf_dir))))
    return rounded(rows, 6, *rows.columns)


@query
def term_idf(spark, sf_dir):
    return rounded(training.term_idf(a.table(spark, sf_dir, "documents"), "text", fixed.ENGLISH_STOP_WORDS), 9, "idf")


@query
def tfidf_title(spark, sf_dir):
    return training.title_weights(cut_lineage(a.cleaned(spark, sf_dir).select("video_id", "country", "trending_date", "title")))


@query
def tfidf_description(spark, sf_dir):
    return training.description_weights(descriptions(spark, sf_dir)).drop("description")


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("description"))


@query
def description_counts(spark, sf_dir):
    return training.text_counts(descriptions(spark, sf_dir), "description", fixed.DESCRIPTION_HASH_BUCKETS).drop("description")


@query
def title_counts(spark, sf_dir):
    rows = a.cleaned(spark, sf_dir).select("video_id", "country", "trending_date", "title")
    return training.text_counts(rows, "title", fixed.TITLE_HASH_BUCKETS)


@query
def train_test_split(spark, sf_dir):
    rows = training.longevity_features(feature_rows(spark, sf_dir))
    return rows.select("video_id", training.in_training_set(F.col("video_id")).alias("in_training_set"))


@query
def regression_metrics(spark, sf_dir):
    """The metrics of two simple predictions: the heuristic for the days, likes for the logarithm of views."""
    rows = scoring.heuristic_days(training.longevity_features(feature_rows(spark, sf_dir)).withColumn("title", F.lit("")))
    days = training.regression_metrics(rows, fixed.LONGEVITY_LABEL, "predicted_days")
    logs = rows.select(F.log(F.col("views") + 1).alias("log_views"), F.log(F.col("likes") + 1).alias("prediction"))
    views = training.regression_metrics(logs, "log_views")
    both = snapshots.union_sources(
        days.withColumn("label", F.lit(fixed.LONGEVITY_LABEL)), views.withColumn("label", F.lit("log_views"))
    )
    return rounded(both, 6, "rmse", "mae", "r2_score")


@query
def metrics_round_trip(spark, sf_dir):
    """Metrics stored twice by one run and once by another: the latest, and how many rows their history has."""
    rows = regression_metrics(spark, sf_dir).where(F.col("label") == fixed.LONGEVITY_LABEL)
    with scratch_folder(spark) as root:
        metrics = cut_lineage(rows.withColumn("training_timestamp", F.lit("2018-01-01T00:00:00")))
        for run_id in ("first", "second", "second"):
            write_metrics(metrics, root, run_id)
        history = serving.metrics_history(spark, root).agg(F.count("*").alias("history_rows"), F.count_distinct("run_id").alias("runs"))
        return cut_lineage(serving.metrics(spark, root).select("*", history.select(F.struct("*")).scalar().alias("h")).select("*", "h.*").drop("h"))


# Scoring


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.resolved_requests(a.metadata(spark, sf_dir), AS_OF)


@query
def score_features(spark, sf_dir):
    names = dict.fromkeys([*fixed.LONGEVITY_FEATURES, *fixed.CLUSTER_FEATURES])
    inputs = scoring.model_inputs(requests(spark, sf_dir), names)
    rows = inputs.select(
        "request.video_id", "request.country", "request.tags", "request.has_tags", "request.description_length", *names
    )
    return rounded(rows, 9, "log_views", "log_likes", "log_comments")


@query
def heuristic_days(spark, sf_dir):
    scored = scoring.heuristic_days(requests(spark, sf_dir))
    return scored.select("video_id", "country", "views", "likes", "comment_count", "predicted_days", "confidence", "days_method")


@query
def url_video_id(spark, sf_dir):
    return a.links(spark, sf_dir).select("url", link_video_id(F.col("url")).alias("video_id"))


@query
def cluster_names(spark, sf_dir):
    rows = a.table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", lookups.cluster_name(F.col("label")).alias("cluster_type"))


# Models. They are fitted once per session and table folder.


@cache
def _trained(application: str, sf_dir: str) -> Trained:
    spark = SparkSession.active()
    read = feature_rows(spark, sf_dir).select("video_id", *fixed.LONGEVITY_FEATURES)  # the clustering takes its own from these
    return train(*inputs(cut_lineage(read), cut_lineage))


def trained(spark: SparkSession, sf_dir: str) -> Trained:
    return _trained(spark.sparkContext.applicationId, sf_dir)


@query
def cluster_assign(spark, sf_dir):
    return trained(spark, sf_dir).assigned.drop("features", "scaledFeatures")


@query
def cluster_quality(spark, sf_dir):
    return training.cluster_quality(trained(spark, sf_dir).assigned)


@query
def regression_quality(spark, sf_dir):
    return training.regression_quality(trained(spark, sf_dir).predicted)


@query
def feature_importance(spark, sf_dir):
    return training.feature_importance(trained(spark, sf_dir).longevity)


@query
def model_metrics(spark, sf_dir):
    return training.model_metrics(
        cluster_quality(spark, sf_dir), regression_quality(spark, sf_dir), feature_rows(spark, sf_dir)
    )


@query
def score_days(spark, sf_dir):
    scored = scoring.score_days(requests(spark, sf_dir), trained(spark, sf_dir).longevity)
    return scored.select("video_id", "country", "views", "predicted_days", "confidence", "days_method")


@query
def score_cluster(spark, sf_dir):
    scored = scoring.score_cluster(requests(spark, sf_dir), trained(spark, sf_dir).clustering)
    return scored.select("video_id", "country", "views", "cluster", "cluster_type", "cluster_method")


@query
def score_both(spark, sf_dir):
    models = trained(spark, sf_dir)
    return scoring.score_both(requests(spark, sf_dir), models.longevity, models.clustering).drop("tag_list")


# Fits that come out the same for any seed.


@query
def cluster_points(spark, sf_dir):
    """Clusters of as many distinct points, each repeated: the point of a cluster, how many it has, and its rows."""
    group = F.col("category_id") % fixed.CLUSTERS
    features = training.cluster_features(feature_rows(spark, sf_dir)).select(group.alias("point"))
    columns = {name: F.when(F.col("point") == i % fixed.CLUSTERS, i + 1.0).otherwise(0.0) for i, name in enumerate(fixed.CLUSTER_FEATURES)}
    rows = cut_lineage(features.withColumns(columns))
    assigned = training.fit_clusters(rows).transform(rows)
    found = assigned.groupBy("cluster").agg(F.min("point").alias("point"), F.count_distinct("point").alias("points"), F.count("*").alias("rows"))
    return found.drop("cluster")


STUMP = ("publish_hour", "tag_count", "video_age_proxy")


def _stump(spark: SparkSession, sf_dir: str, root: str) -> PipelineModel:
    """One split of one tree, on inputs of few values, saved and loaded."""
    rows = cut_lineage(training.longevity_features(feature_rows(spark, sf_dir)))
    save_model(training.fit_longevity(rows, columns=STUMP, trees=1, depth=1, bootstrap=False), root, "days_regression")
    return results.load_models(root)["days_regression"]


@query
def stump_days(spark, sf_dir):
    with scratch_folder(spark) as root:
        scored = scoring.score_days(requests(spark, sf_dir), _stump(spark, sf_dir, root))
        return cut_lineage(scored.select("video_id", "country", "views", "publish_hour", "predicted_days", "confidence", "days_method"))


@query
def stump_importance(spark, sf_dir):
    """The two most important inputs, in order."""
    with scratch_folder(spark) as root:
        ranked = training.feature_importance(_stump(spark, sf_dir, root), 2)
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("importance").desc(), "feature"))
    return ranked.withColumn("rank", rank)


@query
def label_silhouette(spark, sf_dir):
    """The silhouette of embeddings under their given labels."""
    rows = a.table(spark, sf_dir, "embeddings")
    assigned = rows.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("scaledFeatures"), F.col("label").alias("cluster"))
    return rounded(spark.createDataFrame([(training.silhouette(assigned),)], "silhouette_score double"), 6, "silhouette_score")


@query
def description_weights(spark, sf_dir):
    """The weight of every bucket that a description fills."""
    weighted = training.description_weights(descriptions(spark, sf_dir)).drop("description")
    return rounded(training.bucket_weights(weighted, "desc_tfidf"), 9, "weight")


@query
def title_weights(spark, sf_dir):
    """The weight of every bucket that a distinct title fills, among distinct titles."""
    titles = cut_lineage(a.cleaned(spark, sf_dir).select("title").distinct())
    return rounded(training.bucket_weights(training.title_weights(titles), "title_tfidf"), 9, "weight")


# What does not depend on the fit, in the results of the queries above.


@query
def cluster_assign_inputs(spark, sf_dir):
    return rounded(cluster_assign(spark, sf_dir).drop("cluster"), 9, "log_views", "log_likes", "log_comments")


@query
def cluster_quality_facts(spark, sf_dir):
    return cluster_quality(spark, sf_dir).select("num_clusters", F.array_join("features_used", " ").alias("features_used"))


@query
def regression_quality_facts(spark, sf_dir):
    return regression_quality(spark, sf_dir).select("label", F.array_join("features_used", " ").alias("features_used"))


@query
def feature_importance_names(spark, sf_dir):
    return feature_importance(spark, sf_dir).select("feature")


@query
def model_metrics_facts(spark, sf_dir):
    return model_metrics(spark, sf_dir).select("dataset_size", "clustering.num_clusters", "regression.label")


@query
def score_days_facts(spark, sf_dir):
    return score_days(spark, sf_dir).drop("predicted_days")


@query
def score_cluster_facts(spark, sf_dir):
    return score_cluster(spark, sf_dir).drop("cluster", "cluster_type")


@query
def score_both_facts(spark, sf_dir):
    kept = "video_id", "country", "title", "views", "likes", "comment_count", "category_id", "tags", "publish_hour"
    return score_both(spark, sf_dir).select(*kept, "confidence", "days_method", "cluster_method")
