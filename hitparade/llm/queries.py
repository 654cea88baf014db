"""The queries over the operators of this subpackage, and their SQL."""

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.llm import (
    decontamination,
    hard_negatives,
    license_scan,
    line_dedup,
    merkle,
    near_dedup,
    packing,
    quality,
    rule_ensemble,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
)
from hitparade.llm.oracle import ORACLE  # noqa: F401  (registered beside the queries)
from hitparade.llm.stored import new_folder, stored
from hitparade.llm.workers import reach


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def definition(name: str) -> str:
    """The JSON of an installed tokenizer; it is of fixed size."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses found in the documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op1_license_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the notices that reserve all rights."""
    return license_scan.scan(table(spark, sf_dir, "documents"), reserved=True)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of 50 words and more that repeat an earlier place, with that place."""
    return suffix_dedup.repeated(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, its number of ids and their checksum, as read back from the files."""
    path = new_folder(spark, "token-files")
    token_files.write_token_file(table(spark, sf_dir, "documents"), definition("word_bpe_49k.json"), path, end_id=2)
    documents = token_files.read_token_file(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    starts = token_files.segment_starts(spark, path)
    start = F.col("segment_start") + F.col("local_start")
    return documents.join(starts, ["part", "segment_no"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in windows of ten words of the test items, and the items."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.scanned(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def packed(documents: DataFrame) -> DataFrame:
    """The pieces of the documents with their places in sequences of 4096 ids, and the checksums of their ids."""
    cut = stored(packing.pieces(documents, definition("word_bpe_49k.json")), "pieces")
    length, checksum = F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32")
    own = cut.select("part", "row", "doc_id", "piece", "start", length, checksum)
    return own.join(packing.pack(cut), ["part", "row"]).drop("part", "row")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of a document in sequences of 4096 ids."""
    return packed(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), definition("byte_bpe_50k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    rows = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measures = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    return rows.select(F.col("__row.doc_id").alias("doc_id"), *measures, "base_failed", "kept")


URL_RULES = tuple(
    url_filter.Rule(pattern, verdict)
    for pattern, verdict in (
        ("org/", "allow"),
        ("example.org/es/", "block"),
        ("example.org/en/1", "block"),
        ("com/fr/", "allow"),
        ("com/de/", "block"),
    )
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page by rules, else by trees fitted on urls that a seed list labels."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = url_filter.labelled(url_filter.with_parts(pages).where("host != ''"))
    return url_filter.judged(pages, URL_RULES, url_filter.fit(labelled)).select("page_id", "host", "path", "rule", "verdict")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences of repeated passages, with the place of the one that stays."""
    return line_dedup.passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_line_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that has a word and repeats an earlier one, with the place of the one that stays."""
    return line_dedup.repeated(line_dedup.units(table(spark, sf_dir, "documents"))).drop("text_hash")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under four-word shingles."""
    return near_dedup.components_of(table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a leaf of one in three documents, changed, leads to."""
    documents = table(spark, sf_dir, "documents")
    lowered = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    after = merkle.leaf(lowered if c == "text" else F.col(c) for c in merkle.COLUMNS)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, after)
    rows = merkle.manifest(documents, more=tampered)
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("more", "leaf"), F.col("path")))
    own = "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root"
    return rows.select(*own, (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the best neighbours of every row whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mined(rows, F.col("id") % 100 == 0)


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document by rules that are fitted on the labels of three in four ids."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    found = rule_ensemble.scored(documents, rule_ensemble.fit(documents, labels))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op1_license_scan_all,
        op2_suffix_dedup,
        op3_token_files,
        op4_decontamination,
        op5_packing,
        op6_token_counts,
        op7_quality_rules,
        op8_url_filter,
        op9_line_dedup,
        op9_line_dedup_all,
        op10_near_dedup,
        op11_merkle_manifest,
        op12_hard_negatives,
        op13_rule_ensemble,
    )
}
