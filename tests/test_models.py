import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.operators import scoring, training
from hitparade.operators.forest import descent, predicted
from hitparade.plans.training import train
from hitparade.session import cut_lineage, file_system
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    from workload.queries import feature_rows

    features = cut_lineage(feature_rows(spark, SMALL))
    return cut_lineage(training.cluster_features(features)), cut_lineage(training.longevity_features(features))


@pytest.fixture(scope="module")
def trained(inputs):
    return train(*inputs)


def test_clusters_are_nearest_centres(trained):
    rows = trained.assigned.select("scaledFeatures", "cluster").collect()
    points = np.array([r.scaledFeatures.toArray() for r in rows])
    centres = np.array(trained.clustering.stages[-1].clusterCenters())
    distances = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert len(centres) == 3 and (distances.argmin(axis=1) == [r.cluster for r in rows]).all()


def test_silhouette_against_all_pairs(spark, trained):
    sample = trained.assigned.limit(400).cache()
    rows = sample.select("scaledFeatures", "cluster").collect()
    points, clusters = np.array([r.scaledFeatures.toArray() for r in rows]), np.array([r.cluster for r in rows])
    distances = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(clusters):
        mates = (clusters == own).sum()
        if mates == 1:
            scores.append(0.0)
            continue
        inner = distances[i, clusters == own].sum() / (mates - 1)
        outer = min(distances[i, clusters == c].mean() for c in set(clusters) - {own})
        scores.append((outer - inner) / max(inner, outer))
    assert training.silhouette(sample) == pytest.approx(np.mean(scores), abs=1e-9)


def test_scaling_divides_by_deviation(inputs):
    found = training.scaled(inputs[0]).toPandas()
    raw = inputs[0].toPandas().astype(float)
    expected = raw / raw.std(ddof=1)
    assert np.allclose(np.sort(found.to_numpy(), axis=0), np.sort(expected.to_numpy(), axis=0))


def test_fits_repeat(inputs, trained):
    again = train(*inputs)
    assert np.array_equal(again.clustering.stages[-1].clusterCenters(), trained.clustering.stages[-1].clusterCenters())
    first, second = (t.longevity.stages[-1].featureImportances.toArray() for t in (trained, again))
    assert np.array_equal(first, second)


def test_fits_read_files_of_a_size_that_goes_by_rows(spark, monkeypatch):
    """However alike rows are, a split of the files that a fit reads has a bounded number of them."""
    sizes, system = [], lambda path: file_system(spark, path)
    fit = KMeans.fit

    def measured(self, rows):
        files, place = system(rows.inputFiles()[0])
        sizes.append(sum(status.getLen() for status in files.listStatus(place.getParent())) / rows.count())
        return fit(self, rows)

    monkeypatch.setattr(KMeans, "fit", measured)
    rows = spark.range(20_000).select(*[(F.col("id") % 3 * i).cast("double").alias(name) for i, name in enumerate(fixed.CLUSTER_FEATURES)])
    model = training.fit_clusters(cut_lineage(rows))
    assert sizes and min(sizes) >= 8 * len(fixed.CLUSTER_FEATURES)
    assert model.transform(rows).select("cluster").distinct().count() == 3


def test_clusters_are_fitted_on_blocks(inputs, trained):
    """As MLlib fits them on rows, from the same start; rows are held in blocks, not each in objects of its own."""
    kmeans = trained.clustering.stages[-1]
    assert kmeans.getSolver() == "block" and 0 < kmeans.getMaxBlockSizeInMB() <= 0.5
    scaled = training.PipelineModel(trained.clustering.stages[:-1]).transform(inputs[0])
    fits = [
        KMeans(featuresCol="scaledFeatures", k=3, seed=fixed.SEED, maxIter=fixed.CLUSTER_ITERATIONS, solver=solver).fit(scaled)
        for solver in ("row", "block")
    ]
    rows, blocks = (np.array(fit.clusterCenters()) for fit in fits)
    assert np.allclose(rows, blocks, atol=1e-3) and np.isclose(fits[0].summary.trainingCost, kmeans.summary.trainingCost, rtol=1e-2)


def test_split_is_a_partition_of_the_videos(inputs):
    fitting, held_out = (set(r.video_id for r in part.collect()) for part in training.train_test_split(inputs[1]))
    assert not fitting & held_out and len(fitting | held_out) == inputs[1].count()
    assert 0.7 < len(fitting) / (len(fitting) + len(held_out)) < 0.9


def test_importances(trained):
    rows = training.feature_importance(trained.longevity).collect()
    assert {r.feature for r in rows} == set(fixed.LONGEVITY_FEATURES)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_regression_metrics_against_numpy_and_the_evaluator(trained):
    from pyspark.ml.evaluation import RegressionEvaluator

    row = training.regression_quality(trained.predicted).first()
    data = trained.predicted.select(fixed.LONGEVITY_LABEL, "prediction").toPandas().to_numpy(float)
    error = data[:, 0] - data[:, 1]
    assert row.rmse == pytest.approx(math.sqrt((error**2).mean()))
    assert row.mae == pytest.approx(abs(error).mean()) and row.rmse >= row.mae
    assert row.r2_score == pytest.approx(1 - (error**2).sum() / ((data[:, 0] - data[:, 0].mean()) ** 2).sum())
    evaluator = RegressionEvaluator(labelCol=fixed.LONGEVITY_LABEL, metricName="r2")
    assert row.r2_score == pytest.approx(evaluator.evaluate(trained.predicted))


def test_days_in_trending_counts_rows_over_countries(spark, observe):
    from hitparade.operators.features import ml_features

    rows = observe(*[{"country": c, "trending_date": f"17.0{d}.11"} for c in ("US", "GB") for d in (1, 2, 3)])
    assert training.longevity_label(ml_features(rows)).first().days_in_trending == 6


def test_missing_model_columns_get_defaults(spark):
    rows = spark.createDataFrame([(0.2,), (0.1,)], "engagement_score double")
    found = training.with_model_defaults(rows).orderBy("engagement_score").collect()
    assert [(r.publish_hour, r.video_age_proxy) for r in found] == [(12, 2), (12, 1)]


def test_text_weights(spark):
    rows = spark.createDataFrame([(1, "red car the"), (2, "red bus"), (3, None)], "k int, title string")
    found = {r.k: r.title_tfidf for r in training.title_weights(rows).collect()}
    assert sorted(found[1].values) == pytest.approx([math.log(4 / 3), math.log(4 / 2)])
    # Empty text is one empty token to the tokenizer.
    assert list(found[3].values) == pytest.approx([math.log(4 / 2)]) and found[1].size == fixed.TITLE_HASH_BUCKETS
    empty = spark.createDataFrame([("",)], "title string")
    assert training.title_weights(empty).first().title_tfidf == 0.0
    assert training.description_weights(empty).first().desc_tfidf == 0.0


def test_text_counts_do_not_grow_with_the_buckets(spark):
    rows = spark.createDataFrame([(1, "red car the red"), (2, ""), (3, None)], "k int, title string")
    counted = training.text_counts(rows, "title", 300_000_000)
    assert sorted((r.k, r.kept, r.counted) for r in counted.collect()) == [(1, 3, 3.0), (2, 1, 1.0), (3, 1, 1.0)]


@pytest.mark.parametrize("name", ["tfidf_title", "title_weights"])
def test_title_weights_join_the_tables_once(spark, name):
    """Their fit and their result read stored titles."""
    from workload.queries import QUERIES

    assert "Join" not in QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_term_weights_against_python(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [r.text for r in rows.collect()]
    documents = Counter(term for text in texts for term in set(text.lower().split()))
    found = {r.term: (r.documents, r.idf) for r in training.term_idf(rows, "text", ()).collect()}
    assert {term: n for term, (n, _) in found.items()} == dict(documents)
    assert all(idf == pytest.approx(math.log((len(texts) + 1) / (n + 1))) for n, idf in found.values())


def test_request_defaults_and_heuristic(spark):
    rows = spark.createDataFrame([("t", 0, 0), ("u", 10**9, None)], "title string, views bigint, likes bigint")
    found = {r.title: r for r in scoring.heuristic_days(rows).collect()}
    assert found["t"].predicted_days == 0.35 and found["u"].predicted_days == 10.0
    assert (found["t"].publish_hour, found["t"].video_age_proxy, found["t"].confidence) == (12, 2, "medium")


def test_resolved_requests(spark):
    cases = {
        "a": ("2018-01-01T00:30:00Z", ["x", "y"]),
        "b": ("2017-12-30T23:00:00-05:00", []),
        "c": ("2017-12-01T05:00:00", None),
        "d": ("unknown", ["z"]),
        "e": (None, None),
    }
    rows = spark.createDataFrame(
        [(k, 5, "abc", *v) for k, v in cases.items()],
        "title string, views bigint, description string, published_at string, tag_list array<string>",
    )
    found = {r.title: r for r in scoring.resolved_requests(rows, "2018-01-02T00:00:00Z").collect()}
    assert {k: (r.publish_hour, r.video_age_proxy, r.tags, r.has_tags) for k, r in found.items()} == {
        "a": (0, 1, "x|y", True),
        "b": (23, 1, "", False),
        "c": (5, 2, "", False),
        "d": (12, 2, "z", True),
        "e": (12, 2, "", False),
    }
    assert found["a"].description_length == 3


def test_scores_keep_the_request(spark, trained):
    rows = spark.createDataFrame([("t", 0, 3, "a|b")], "title string, views bigint, likes bigint, tags string")
    row = scoring.score_both(rows, trained.longevity, trained.clustering).first()
    assert (row.views, row.likes, row.tags) == (0, 3, "a|b")
    assert row.predicted_days >= 0 and row.predicted_days == round(row.predicted_days, 2)
    assert row.cluster in (0, 1, 2) and row.cluster_type == fixed.CLUSTER_NAMES[row.cluster]
    assert (row.confidence, row.days_method, row.cluster_method) == ("high", "spark_mllib", "spark_mllib")
    fallback = scoring.score_both(rows, None, trained.clustering).first()
    assert (fallback.confidence, fallback.days_method) == ("medium", "heuristic")
    with pytest.raises(ValueError):
        scoring.score_cluster(rows, None)


def test_model_inputs(spark):
    rows = spark.createDataFrame([("tit", 0, 3, "")], "title string, views bigint, likes bigint, tags string")
    row = scoring.model_inputs(rows, fixed.CLUSTER_FEATURES).first()
    assert (row.like_ratio, row.title_length, row.tag_count, row.publish_hour) == (3.0, 3.0, 0.0, 12.0)
    assert row.log_views == pytest.approx(math.log(2)) and row.log_likes == pytest.approx(math.log(4))
    days = scoring.model_inputs(rows, fixed.LONGEVITY_FEATURES).select(F.col("views")).first()
    assert days.views == 1.0


def test_days_are_those_of_the_forest_from_batches_of_rows(spark, inputs, trained):
    """The forest's own prediction to the last bit, also at its thresholds, without its call for each row."""
    forest = trained.longevity.stages[-1]
    features = inputs[1].select(*fixed.LONGEVITY_FEATURES).withColumn("title", F.lit("abc"))
    scaled = training.PipelineModel(trained.longevity.stages[:-1]).transform(scoring.model_inputs(features, fixed.LONGEVITY_FEATURES))
    both = predicted(forest.copy().setPredictionCol("ours"), forest.transform(scaled))
    assert both.where("prediction != ours or ours is null").isEmpty() and both.count() == features.count()
    at_thresholds = _thresholds(forest)
    assert list(descent(forest)(at_thresholds)) == [forest.predict(Vectors.dense(row)) for row in at_thresholds]
    plan = scoring.score_days(features, trained.longevity)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan


def _thresholds(forest):
    """Rows whose inputs are thresholds of the first trees."""
    found = re.findall(r"feature (\d+) <= (\S+)\)", "".join(tree.toDebugString for tree in forest.trees[:3]))
    rows = np.zeros((200, forest.numFeatures))
    for i, (feature, threshold) in enumerate(found):
        rows[i % len(rows) :, int(feature)] = float(threshold)
    return rows
