"""Stored tables: results, features and models."""

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.schemas import TABLES
from hitparade.sources.versions import table_path

NUMBER_COLUMNS = ("views", "likes", "dislikes", "comment_count", "category_id")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(table_path(spark, root, name))


def with_document_date(documents: DataFrame) -> DataFrame:
    """Documents with `date`, taken from the older `trending_date` where it is missing."""
    if "trending_date" not in documents.columns:
        return documents
    if "date" not in documents.columns:
        return documents.withColumnRenamed("trending_date", "date")
    return documents.withColumn("date", F.coalesce("date", "trending_date")).drop("trending_date")


def on_date(documents: DataFrame, date: str) -> DataFrame:
    """Documents of a date, under either name; both comparisons can reach the files."""
    columns = [F.col(name) == date for name in ("date", "trending_date") if name in documents.columns]
    return documents.filter(reduce(or_, columns))


def training_input(features: DataFrame) -> DataFrame:
    """Feature rows with null counters as 0 and null text as ''."""
    texts = [name for name, kind in features.dtypes if kind == "string" and name not in NUMBER_COLUMNS]
    numbers = [name for name in NUMBER_COLUMNS if name in features.columns]
    return features.drop("_id").na.fill(0, numbers).na.fill("", texts)


def read_training_input(spark: SparkSession, root: str) -> DataFrame | None:
    """Stored feature rows for training, None where there are none."""
    try:
        features = read_table(spark, root, "ml_features")
    except AnalysisException:
        return None
    return None if features.isEmpty() else training_input(features)


def load_models(root: str, names=("clustering", "days_regression")) -> dict[str, PipelineModel]:
    """The models that exist under {root}/models."""
    spark = SparkSession.active()
    found = {}
    for name in names:
        path = f"{root}/models/{name}"
        try:
            spark.read.text(f"{path}/metadata").isEmpty()
        except AnalysisException:
            continue
        found[name] = PipelineModel.load(path)
    return found
