"""Predictions of a fitted forest for whole tables."""

from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.session import scratch_folder

FEW_TREES = 10


def _nodes(model: RandomForestRegressionModel) -> dict[str, np.ndarray]:
    """The nodes of all trees, ascending by tree and id, from the model as MLlib stores it: as many as it has, at any input."""
    spark = SparkSession.active()
    with scratch_folder(spark) as folder:
        model.write().save(folder)
        stored = spark.read.parquet(f"{folder}/data").select(
            F.col("treeID").alias("tree"),
            "nodeData.id",
            "nodeData.prediction",
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("input"),
            F.coalesce(F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
        )
        table = stored.toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
    return {name: table[name].to_numpy() for name in table.column_names}


def _tree(nodes: dict[str, np.ndarray], thresholds: list[np.ndarray]) -> tuple:
    """Inputs, how many thresholds may be below, children by (node, goes right), values and depth; leaves lead to themselves."""
    inner = nodes["left"] >= 0
    own = np.arange(len(inner))
    source, limit = np.where(inner, nodes["input"], 0), np.zeros(len(inner), np.uint32)
    for i, cuts in enumerate(thresholds):
        of_input = inner & (source == i)
        limit[of_input] = np.searchsorted(cuts, nodes["threshold"][of_input])
    children = np.stack([np.where(inner, nodes[side], own) for side in ("left", "right")], 1).astype(np.intp).ravel()
    level, depth = own[:1], 0
    while (level := level[inner[level]]).size:
        level, depth = np.concatenate([children[2 * level], children[2 * level + 1]]), depth + 1
    return source.astype(np.intp), limit, children, nodes["prediction"], depth


@lru_cache(maxsize=4)
def descent(model: RandomForestRegressionModel):
    """A function from rows of inputs to predictions, for trees over continuous inputs.

    A row goes left where its input is at most the threshold. Inputs take few thresholds in all, so a row is reduced first to
    how many thresholds of each input are below it; then all rows go down one level of a tree at a time. The function is
    sent to the workers as a whole, which need not have this package.
    """
    nodes = _nodes(model)
    inner = nodes["left"] >= 0
    thresholds = [np.unique(nodes["threshold"][inner & (nodes["input"] == i)]) for i in range(model.numFeatures)]
    kind = np.min_scalar_type(max(map(len, thresholds)))  # small numbers stay in the processor's cache
    starts = np.append(np.flatnonzero(np.diff(nodes["tree"], prepend=-1)), len(inner))
    trees = [_tree({name: values[a:b] for name, values in nodes.items()}, thresholds) for a, b in pairwise(starts)]

    def predict(values: np.ndarray) -> np.ndarray:
        """The mean of the trees' predictions, added up tree by tree as MLlib does."""
        n = len(values)
        below = np.concatenate([np.searchsorted(cuts, values[:, i]) for i, cuts in enumerate(thresholds)])
        below, rows, total = below.astype(kind), np.arange(n), np.zeros(n)
        for source, limit, children, prediction, depth in trees:
            place, limit, node = source * n, limit.astype(kind), np.zeros(n, np.intp)
            for _ in range(depth):
                # No place is out of bounds; "clip" only spares the check.
                right = below.take(place.take(node, mode="clip") + rows, mode="clip") > limit.take(node, mode="clip")
                node = children.take(2 * node + right, mode="clip")
            total += prediction.take(node)
        return total / len(trees)

    return predict


def predicted(model: RandomForestRegressionModel, rows: DataFrame) -> DataFrame:
    """Rows with the model's prediction, as its transform gives it, for batches of rows and a tree at a time.

    A few trees are left to MLlib: they take less than the way to Python and back.
    """
    if model.getNumTrees < FEW_TREES:
        return model.transform(rows)
    predict, inputs = descent(model), model.numFeatures

    @F.arrow_udf("double")
    def prediction(vectors: pa.Array) -> pa.Array:
        return pa.array(predict(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, inputs)))

    return rows.withColumn(model.getPredictionCol(), prediction(vector_to_array(model.getFeaturesCol())))
