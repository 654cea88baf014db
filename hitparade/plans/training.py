"""Training: stored feature rows to stored models and metrics."""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from hitparade import fixed
from hitparade.operators import training as op
from hitparade.operators.statistics import training_gate
from hitparade.session import scratch
from hitparade.sinks.tables import save_model, write_metrics
from hitparade.sources.results import read_training_input


@dataclass
class Trained:
    clustering: PipelineModel
    longevity: PipelineModel
    assigned: DataFrame
    predicted: DataFrame


def inputs(features: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The inputs of both models, each sorted and stored once: fits read them several times, and always in one order."""
    cluster_rows = op.cluster_features(features).sortWithinPartitions(*fixed.CLUSTER_FEATURES)
    return cut(cluster_rows), cut(op.longevity_features(features).sortWithinPartitions("video_id"))


def train(cluster_rows: DataFrame, longevity_rows: DataFrame) -> Trained:
    """Both models, the clustering of its input and the longevity predictions for the held-out videos.

    The rows are stored tables, as inputs() gives them.
    """
    fitting, held_out = op.train_test_split(longevity_rows)
    clustering = op.fit_clusters(cluster_rows)
    longevity = op.fit_longevity(fitting)
    return Trained(clustering, longevity, clustering.transform(cluster_rows), longevity.transform(held_out))


def run_training(spark: SparkSession, root: str, stamp: str | None = None, run_id: str | None = None) -> dict | None:
    """Train on the stored features and store both models and their metrics; None without enough rows.

    A run that is repeated under its id adds nothing to the history of the metrics; without an id every run is new.
    """
    features = read_training_input(spark, root)
    if features is None or not training_gate(features).first()["enough"]:
        return None
    with scratch(spark) as cut:
        trained = train(*inputs(features, cut))
        save_model(trained.clustering, root, "clustering")
        save_model(trained.longevity, root, "days_regression")
        metrics = op.model_metrics(
            op.cluster_quality(trained.assigned), op.regression_quality(trained.predicted), features, stamp
        )
        row = cut(metrics)
        write_metrics(row, root, run_id or str(uuid.uuid4()))
        return row.first().asDict(recursive=True)
