"""Cutting spans of characters out of texts."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade.llm import words


def merged(spans) -> list[tuple[int, int]]:
    """Spans in rising order, those that touch or overlap as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(start, end) for start, end in out]


def cut(text: str, spans) -> str:
    parts, at = [], 0
    for start, end in merged(spans):
        parts.append(text[at:start])
        at = end
    return "".join([*parts, text[at:]])


def with_lengths(changed: DataFrame, documents: DataFrame) -> DataFrame:
    """The changed rows with the columns and types of documents; n_chars, where there is one, is that of the new text."""
    columns = {name: F.col(name) for name in documents.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return changed.select(*(column.cast(documents.schema[name].dataType).alias(name) for name, column in columns.items()))


def _cut_rows(drop_emptied: bool):
    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            row = batch.column("row")
            names = [field.name for field in row.type]
            columns = dict(zip(names, row.flatten()))
            texts, stays = [], []
            for text, spans in zip(columns["text"].to_pylist(), batch.column("spans").to_pylist()):
                if text is not None and spans:
                    text = cut(text, ((s["start"], s["end"]) for s in spans))
                    stays.append(bool(text.strip()) or not drop_emptied)
                else:
                    stays.append(True)
                texts.append(text)
            columns["text"] = pa.array(texts, pa.string())
            yield pa.record_batch([columns[name] for name in names], names).filter(pa.array(stays, pa.bool_()))

    return cut_rows


def cut_out(rows: DataFrame, documents: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """rows has documents' rows as the struct row and the spans (start, end in code points) to cut out of their texts.

    drop_emptied leaves out the rows of which nothing but white space remains.
    """
    changed = rows.select("row", "spans").mapInArrow(_cut_rows(drop_emptied), rows.schema["row"].dataType)
    return with_lengths(changed, documents)


def as_rows(documents: DataFrame) -> DataFrame:
    """All columns in the struct row, so that no name of theirs clashes with another."""
    return documents.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row"))


def without(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents with the spans (doc_id, text_hash, start, end) cut out of their texts. The spans of one id and text are
    collected: there are at most as many as the text has words."""
    own = spans.groupBy(F.col("doc_id").alias("of"), "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("of")) & (F.xxhash64("row.text") == F.col("text_hash"))
    return cut_out(as_rows(documents).join(own, same, "left"), documents)
