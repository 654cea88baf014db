"""Names of categories and clusters."""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitparade import fixed


def mapping(names: DataFrame, mapping_country: str = fixed.CATEGORY_COUNTRY) -> DataFrame:
    """(category_key, category_name) of one country's dictionary, by default the same for all countries."""
    return names.filter(F.col("country") == mapping_country).select(
        F.col("category_id").cast("string").alias("category_key"), "category_name"
    )


def numbered(category_id: Column) -> Column:
    return F.concat(F.lit("Category "), category_id.cast("string"))


def with_category_name(
    rows: DataFrame,
    names: DataFrame,
    fallback: Column | None = None,
    mapping_country: str = fixed.CATEGORY_COUNTRY,
) -> DataFrame:
    """Rows with category_name, `Category {id}` unless another fallback is given.

    The join is left to the optimizer: a dictionary below the broadcast threshold is broadcast,
    a larger one is joined by key.
    """
    if fallback is None:
        fallback = numbered(F.col("category_id"))
    return (
        rows.withColumn("category_key", F.col("category_id").cast("string"))
        .join(mapping(names, mapping_country), "category_key", "left")
        .withColumn("category_name", F.coalesce("category_name", fallback))
        .drop("category_key")
    )


def cluster_name(cluster: Column) -> Column:
    """Name of a cluster number; the numbers are arbitrary after each training."""
    names = F.create_map(*[F.lit(part) for part in chain.from_iterable(fixed.CLUSTER_NAMES.items())])
    return F.coalesce(F.try_element_at(names, cluster), F.concat(F.lit("Cluster "), cluster.cast("string")))
