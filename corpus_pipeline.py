"""From documents to packed sequences: five stages, each written as Parquet and read again as the next one's documents."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hitparade.llm import decontamination, near_dedup, quality, suffix_dedup
from hitparade.llm.queries import packed, table
from hitparade.llm.stored import new_folder
from hitparade.llm.workers import reach


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass every quality rule."""
    return quality.kept(docs, language="lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 and more: the one with the smallest doc_id."""
    reach(spark)
    return near_dedup.deduplicated(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 50 words and more that stand at an earlier place."""
    reach(spark)
    return suffix_dedup.deduplicated(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without spans of ten words and more of test items; those of which they are most go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 4096 ids."""
    reach(spark)
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("packing", packing_plan),
]

#: The last stage needs the tokenizer, and no SQL has it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
