"""Removal of repeated lines, paragraphs or sentences by digests of normalised units."""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitparade.llm import words
from hitparade.llm.spans import without
from hitparade.llm.stored import stored

UNITS = "doc_id long, text_hash long, unit int, place int, start int, end int, n_words int, digest binary"
KINDS = (pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.binary())
#: A sentence ends with its mark before white space, or with its line.
SENTENCES = re.compile("(?<=[.!?])(?=[ \t\x0b\x0c\r])")
#: Sentences that repeat one after the other are listed from so many words on: fewer are found in clean texts by chance.
PASSAGE = 25


def _units(separator: str, min_words: int, sentences: bool):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            rows: list[tuple] = []
            for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))):
                start = number = place = 0
                for part in (text or "").split(separator):
                    for unit in SENTENCES.split(part) if sentences else (part,):
                        own = unit.encode().lower().split()
                        if len(own) >= min_words:
                            digest = hashlib.blake2b(b" ".join(own), digest_size=16).digest()
                            rows.append((doc_id, text_hash, number, place, start, start + len(unit), len(own), digest))
                            place += 1
                        start, number = start + len(unit), number + 1
                    start += len(separator)
            columns = zip(*rows) if rows else [[]] * len(KINDS)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, KINDS)], [c.split()[0] for c in UNITS.split(", ")])

    return found


def units(documents: DataFrame, separator: str = "\n", min_words: int = 1, sentences: bool = False) -> DataFrame:
    """Units of at least min_words words with their place in the text and a 128-bit digest of the normalised unit.

    Units are the parts between separators, or the sentences in them: a cut comes after . ! or ? before a blank, which
    begins the next unit. Normalised: A-Z in lower case, words joined by one space. Null texts have no units.
    """
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = chosen.withColumn("text_hash", F.xxhash64("text"))
    return chosen.mapInArrow(_units(separator, min_words, sentences), UNITS)


def repeated(found: DataFrame, min_run: int = 1) -> DataFrame:
    """The units that repeat an earlier one: doc_id, text_hash, unit, start, end, n_words, kept_doc_id, kept_start.

    The earliest has the smallest doc_id (none counts as the smallest), then the smallest hash of its text, then the
    smallest start; rows that are equal in id and text are one document. Units count only where those that repeat one after
    the other, with no other unit between them, have at least min_run words together. Digests are counted before they are
    shuffled, and only narrow rows move; a digest's units never meet in one task but where adaptive execution may split them.
    """
    order = F.struct("doc_id", "text_hash", "start")
    first = found.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored, so that a hot digest stands in a plain join of two shuffles, which adaptive execution splits.
    first = stored(first, "first-units")
    own = "doc_id", "text_hash", "unit", "start", "end", "n_words"
    kept = F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_start")
    joined = found.join(first, "digest").where(order != F.col("first")).select(*own, *kept, "place")
    joined = joined.repartition("doc_id", "text_hash").distinct()
    if min_run > 1:
        in_text = Window.partitionBy("doc_id", "text_hash")
        joined = joined.withColumn("run", F.col("place") - F.row_number().over(in_text.orderBy("place")))
        size = F.sum("n_words").over(Window.partitionBy("doc_id", "text_hash", "run"))
        joined = joined.withColumn("size", size).where(F.col("size") >= min_run)
    return joined.select(*own, "kept_doc_id", "kept_start")


def passages(documents: DataFrame, min_run: int = PASSAGE) -> DataFrame:
    """The repeated sentences of passages of at least min_run words."""
    return repeated(units(documents, sentences=True), min_run)


def deduplicated(documents: DataFrame, separator: str = "\n", min_words: int = 1, sentences: bool = False, min_run: int = 1) -> DataFrame:
    """The documents without their repeated units."""
    return without(documents, repeated(units(documents, separator, min_words, sentences), min_run))
