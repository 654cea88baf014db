"""Model inputs, models and their quality."""

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, StopWordsRemover, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.numbers import log_plus_one
from hitparade.functions.times import processed_at
from hitparade.session import scratch

#: Parquet of a size that depends on the number of values only, in row groups that splits can keep apart.
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 * 2**20)}


def with_model_defaults(features: DataFrame) -> DataFrame:
    """Features with a publish hour and an age bucket, where those columns are missing."""
    defaults = {
        "publish_hour": F.lit(12),
        "video_age_proxy": F.when(F.col("engagement_score") > 0.1, 1).otherwise(2),
    }
    return features.withColumns({name: value for name, value in defaults.items() if name not in features.columns})


def cluster_features(features: DataFrame) -> DataFrame:
    """The ten inputs of the clustering model, one row per observation."""
    logs = {"log_views": "views", "log_likes": "likes", "log_comments": "comment_count"}
    return (
        with_model_defaults(features)
        .withColumns({name: log_plus_one(F.col(counter)) for name, counter in logs.items()})
        .select(*fixed.CLUSTER_FEATURES)
        .na.fill(0)
    )


def longevity_label(features: DataFrame) -> DataFrame:
    """Largest measures per video, and its number of rows over all countries as days_in_trending."""
    measures = [name for name in fixed.LONGEVITY_FEATURES if name not in ("like_ratio", "engagement_score")]
    return (
        with_model_defaults(features)
        .groupBy("video_id")
        .agg(*[F.max(name).alias(name) for name in measures], F.count("*").alias(fixed.LONGEVITY_LABEL))
    )


def longevity_features(features: DataFrame) -> DataFrame:
    """The ten inputs of the longevity model with their label, one row per video."""
    views = F.col("views") + F.lit(fixed.RATIO_EPSILON)
    return (
        longevity_label(features)
        .withColumns(
            {
                "like_ratio": F.col("likes") / views,
                "engagement_score": (F.col("likes") + F.col("comment_count")) / views,
            }
        )
        .select("video_id", *fixed.LONGEVITY_FEATURES, fixed.LONGEVITY_LABEL)
        .na.fill(0)
    )


def in_training_set(video_id: Column, seed: int = fixed.SEED) -> Column:
    """Membership of a video in the training part: eight in ten, the same in every run and partitioning."""
    digest = F.md5(F.concat_ws("-", video_id, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10 < fixed.TRAIN_TENTHS


def train_test_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    member = in_training_set(F.col("video_id"))
    return rows.filter(member), rows.filter(~member)


def _scaled(columns, *stages) -> Pipeline:
    """Assembler, scaling to unit deviation without centring, then the given stages."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return Pipeline(stages=[assembler, StandardScaler(inputCol="features", outputCol="scaledFeatures"), *stages])


def fit_scaling(rows: DataFrame, columns=fixed.CLUSTER_FEATURES) -> PipelineModel:
    return _scaled(columns).fit(rows)


def _fitted(columns, estimator: Estimator, rows: DataFrame, *kept: str) -> PipelineModel:
    """Scaling, then the estimator, fitted on the columns and the kept ones.

    MLlib holds the rows of an input split as objects in one task. Values that repeat take next to nothing in a file, so a split
    of 128 MB could have many millions of rows. The rows are stored for the fit as doubles without dictionaries and compression:
    a split of ten inputs has under two million, whatever they hold.
    """
    values = [F.col(name).cast("double").alias(name) for name in columns]
    with scratch(rows.sparkSession) as cut:
        return _scaled(columns, estimator).fit(cut(rows.select(*values, *kept), **PLAIN))


def scaled(rows: DataFrame, columns=fixed.CLUSTER_FEATURES) -> DataFrame:
    """Each column divided by its standard deviation."""
    values = vector_to_array("scaledFeatures")
    vectors = fit_scaling(rows, columns).transform(rows).withColumn("values", values)
    return vectors.select(*[F.get("values", F.lit(i)).alias(name) for i, name in enumerate(columns)])


def fit_clusters(rows: DataFrame, k: int = fixed.CLUSTERS, seed: int = fixed.SEED) -> PipelineModel:
    """Clusters by Lloyd's steps. Blocks hold 8 bytes a value between steps, where MLlib's row solver holds an object for each row.

    They are small, so that none takes up regions of a small heap of its own.
    """
    kmeans = KMeans(
        featuresCol="scaledFeatures",
        predictionCol="cluster",
        k=k,
        seed=seed,
        maxIter=fixed.CLUSTER_ITERATIONS,
        solver="block",
        maxBlockSizeInMB=0.25,
    )
    return _fitted(fixed.CLUSTER_FEATURES, kmeans, rows)


def fit_longevity(
    rows: DataFrame,
    seed: int = fixed.SEED,
    columns=fixed.LONGEVITY_FEATURES,
    trees: int = fixed.FOREST_TREES,
    depth: int = fixed.FOREST_DEPTH,
    bootstrap: bool = True,
) -> PipelineModel:
    """A forest for the days in trending. One tree without bootstrap is fitted to all rows, whatever the seed."""
    forest = RandomForestRegressor(
        featuresCol="scaledFeatures",
        labelCol=fixed.LONGEVITY_LABEL,
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=depth,
        bootstrap=bootstrap,
        seed=seed,
        # The same trees; without it, rows go down from the root again for each level.
        cacheNodeIds=True,
    )
    return _fitted(columns, forest, rows, fixed.LONGEVITY_LABEL)


def silhouette(assigned: DataFrame) -> float:
    """Mean silhouette of rows (scaledFeatures, cluster) by squared distance; the clusters may come from anywhere."""
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="scaledFeatures").evaluate(assigned)


def cluster_quality(assigned: DataFrame, k: int = fixed.CLUSTERS) -> DataFrame:
    row = (silhouette(assigned), k, list(fixed.CLUSTER_FEATURES))
    return assigned.sparkSession.createDataFrame(
        [row], "silhouette_score double, num_clusters int, features_used array<string>"
    )


def regression_metrics(rows: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """rmse, mae and r2_score of a prediction column, in one pass; r2 is against the label's mean."""
    error = F.col(label) - F.col(prediction)
    spread = F.var_pop(label)
    squared = F.avg(error * error)
    return rows.agg(
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squared, spread)).alias("r2_score"),
    )


def regression_quality(predicted: DataFrame, label: str = fixed.LONGEVITY_LABEL) -> DataFrame:
    return regression_metrics(predicted, label).select(
        "*",
        F.lit(label).alias("label"),
        F.array(*[F.lit(name) for name in fixed.LONGEVITY_FEATURES]).alias("features_used"),
    )


def model_metrics(
    clustering: DataFrame, regression: DataFrame, features: DataFrame, stamp: str | None = None
) -> DataFrame:
    """One row: both models' metrics, the time and the number of feature rows."""
    clusters = clustering.select(F.struct("*")).scalar()
    errors = regression.select(F.struct("*")).scalar()
    return features.agg(F.count("*").alias("dataset_size")).select(
        clusters.alias("clustering"),
        errors.alias("regression"),
        processed_at(stamp).alias("training_timestamp"),
        "dataset_size",
    )


def feature_importance(model: PipelineModel, n: int | None = None) -> DataFrame:
    """(feature, importance) of a fitted forest, most important first: all of them, or the first n."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = SparkSession.active().createDataFrame(list(zip(names, values)), "feature string, importance double")
    ranked = rows.orderBy(F.col("importance").desc(), "feature")
    return ranked if n is None else ranked.limit(n)


def _counting(text: str, output: str, buckets: int) -> list:
    """Tokens without stop words, hashed to buckets."""
    return [
        Tokenizer(inputCol=text, outputCol=f"{output}_tokens"),
        StopWordsRemover(inputCol=f"{output}_tokens", outputCol=f"{output}_kept", stopWords=list(fixed.ENGLISH_STOP_WORDS)),
        HashingTF(inputCol=f"{output}_kept", outputCol=f"{output}_counts", numFeatures=buckets),
    ]


def fit_text_weights(rows: DataFrame, text: str, output: str, buckets: int) -> PipelineModel:
    """Bucket counts of the text, weighted by inverse document frequency."""
    return Pipeline(stages=[*_counting(text, output, buckets), IDF(inputCol=f"{output}_counts", outputCol=output)]).fit(rows)


def text_counts(rows: DataFrame, text: str, buckets: int) -> DataFrame:
    """Rows with the number of tokens kept and the sum of their bucket counts, as the text weights count them."""
    counted = PipelineModel(_counting(text, "text", buckets)).transform(rows.na.fill("", [text]))
    # Of the buckets that the text fills only: as an array, the vector would have every bucket.
    total = F.aggregate(F.unwrap_udt("text_counts")["values"], F.lit(0.0), lambda total, n: total + n)
    return counted.select(*rows.columns, F.size("text_kept").cast("bigint").alias("kept"), total.alias("counted"))


def text_weights(rows: DataFrame, text: str, output: str, buckets: int) -> DataFrame:
    """Rows with a weight vector for the text, or with 0.0 where no row has text."""
    if text not in rows.columns or rows.filter(F.col(text) != "").isEmpty():
        return rows.withColumn(output, F.lit(0.0))
    filled = rows.na.fill("", [text])
    model = fit_text_weights(filled, text, output, buckets)
    return model.transform(filled).select(*rows.columns, output)


def bucket_weights(weighted: DataFrame, weights: str) -> DataFrame:
    """The other columns of weighted, with one row (bucket, weight) for each bucket that weighs anything."""
    others = [name for name in weighted.columns if name != weights]
    entries = weighted.select(*others, F.posexplode(vector_to_array(weights)).alias("bucket", "weight"))
    return entries.where("weight != 0")


def title_weights(rows: DataFrame) -> DataFrame:
    return text_weights(rows, "title", "title_tfidf", fixed.TITLE_HASH_BUCKETS)


def description_weights(rows: DataFrame) -> DataFrame:
    return text_weights(rows, "description", "desc_tfidf", fixed.DESCRIPTION_HASH_BUCKETS)


def term_idf(rows: DataFrame, text: str, stop_words) -> DataFrame:
    """(term, documents, idf) with idf = ln((rows + 1) / (documents + 1)), as one weight per term."""
    terms = F.array_distinct(F.split(F.lower(F.col(text)), r"\s"))
    total = rows.agg(F.count("*")).scalar()
    return (
        rows.select(F.explode(terms).alias("term"))
        .filter((F.col("term") != "") & ~F.col("term").isin(*stop_words))
        .groupBy("term")
        .agg(F.count("*").alias("documents"))
        .withColumn("idf", F.log((total + 1) / (F.col("documents") + 1)))
    )
