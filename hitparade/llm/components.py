"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade.llm.stored import by_shuffle, stored


def components(links: DataFrame) -> DataFrame:
    """node and label, the smallest node it reaches, for every node of the links (a, b: long).

    Each step is two aggregations and two joins over the links that are left, written to the shared folder; the number of
    steps grows with the logarithm of the longest chain. Neighbours are never collected, so a node may have any number.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars, state = stored(links.where("a != b").select(high, low).distinct(), "links"), None
    while True:
        # Large star: neighbours above a node are linked to the smallest neighbour of all.
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(by_shuffle(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large, "large-star")
        # Small star: neighbours below a node, and the node, are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(by_shuffle(least), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
