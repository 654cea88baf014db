"""Token id files: documents in ascending id order as one array of ids, with Elias-Fano coded boundaries.

A file table has one row per segment: a run of whole documents of about SEGMENT_TOKENS ids. Its ``segment`` bytes hold, in
this order: MAGIC, four little-endian 64-bit sizes (documents, ids, bytes of the boundaries, 1 if document ids follow), the
ends of the documents in Elias-Fano code, the document ids (64 bits each), a byte for each document that is 1 where its id
is null, and the token ids (16 bits each). The rows are stored as Parquet, so any store that Spark reaches can hold them.

Null texts are empty texts. Rows without doc_id come first. Rows that repeat a doc_id each keep their place; their order is
that of a hash of their texts. An empty table gives a file of no segments.
"""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitparade.llm import tokens, words
from hitparade.llm.elias_fano import EliasFano

MAGIC = b"IDSEG001"
SIZES = struct.Struct("<3Q")
#: A segment closes with the document that reaches so many ids: about 8 MB.
SEGMENT_TOKENS = 1 << 22
#: Documents whose places are selected at a time.
READ = 4096
FILE_SCHEMA = "part int, segment_no long, n_documents long, n_tokens long, segment binary"
READ_SCHEMA = "part int, segment_no long, place long, doc_id long, local_start long, n_tokens long, ids binary"


class Segment:
    """A decoded segment: ids of document i by position, without decoding the others."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a segment")
        self.n_documents, self.n_tokens, coded = SIZES.unpack_from(data, len(MAGIC))
        at = len(MAGIC) + SIZES.size
        self.ends = EliasFano.from_bytes(data[at : at + coded])
        at += coded
        self.doc_ids = np.frombuffer(data, "<i8", self.n_documents, at)
        at += 8 * self.n_documents
        self.unnamed = np.frombuffer(data, "?", self.n_documents, at)
        self.ids = np.frombuffer(data, "<u2", self.n_tokens, at + self.n_documents)

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.ends.select(i)]

    @staticmethod
    def pack(doc_ids: np.ndarray, unnamed: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
        coded = EliasFano.of(ends).to_bytes()
        head = MAGIC + SIZES.pack(len(doc_ids), len(ids), len(coded)) + coded
        return head + doc_ids.astype("<i8").tobytes() + unnamed.astype("?").tobytes() + ids.astype("<u2").tobytes()


def _segments(definition, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def closed() -> pa.RecordBatch:
            doc_ids, unnamed, sizes, ids = (np.concatenate(x) for x in zip(*held))
            data = Segment.pack(doc_ids, unnamed, np.cumsum(sizes), ids)
            columns = [[part], [number], [len(doc_ids)], [len(ids)], [data]]
            names = ["part", "segment_no", "n_documents", "n_tokens", "segment"]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in words.slices(batches):
            encoder = tokens.encoder(definition.value)
            ids, offsets = tokens.with_end(*encoder.encode(batch.column("text")), end_id)
            doc_ids = batch.column("doc_id")
            unnamed = doc_ids.is_null().to_numpy(zero_copy_only=False)
            held.append((doc_ids.fill_null(0).to_numpy(), unnamed, np.diff(offsets), ids))
            size += len(ids)
            if size >= SEGMENT_TOKENS:
                yield closed()
                number, held, size = number + 1, [], 0
        if held:
            yield closed()

    return encode


def write_token_file(documents: DataFrame, definition: str, path: str, end_id: int = 2) -> None:
    """Encode every whole text, append end_id, and write the segments to path.

    definition is the JSON of a tokenizer of the tokenizers library with at most 65,536 ids. Documents are dealt out by
    ranges of doc_id, so that each task writes its own consecutive part; none of it passes through the driver.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id").asc_nulls_first(), F.col("__tie")
    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("__tie", F.xxhash64("text"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    shared = spark.sparkContext.broadcast(definition)
    ordered.mapInArrow(_segments(shared, end_id), FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of segments. Their places come from selects of READ documents each, so no table of them is made."""
    for batch in batches:
        for part, number, data in zip(*(batch.column(c) for c in ("part", "segment_no", "segment"))):
            segment = Segment(data.as_py())
            before = 0
            for first in range(0, segment.n_documents, READ):
                ends = segment.ends.run(first, min(first + READ, segment.n_documents))
                starts = np.r_[before, ends[:-1]]
                before = int(ends[-1])
                # Slices of bounded size; each document's ids as little-endian unsigned 32-bit integers.
                run = starts // (SEGMENT_TOKENS // 4)
                cuts = [*np.flatnonzero(np.r_[True, run[1:] != run[:-1]]).tolist(), len(ends)]
                for a, b in zip(cuts, cuts[1:]):
                    low, high = int(starts[a]), int(ends[b - 1])
                    bounds = pa.py_buffer((4 * (np.r_[starts[a:b], high] - low)).astype("<i4"))
                    own = slice(first + a, first + b)
                    yield pa.record_batch(
                        [
                            pa.array(np.full(b - a, part.as_py(), np.int32)),
                            pa.array(np.full(b - a, number.as_py(), np.int64)),
                            pa.array(np.arange(first + a, first + b)),
                            pa.array(segment.doc_ids[own], mask=segment.unnamed[own]),
                            pa.array(starts[a:b]),
                            pa.array((ends - starts)[a:b]),
                            pa.Array.from_buffers(pa.binary(), b - a, [None, bounds, pa.py_buffer(segment.ids[low:high].astype("<u4"))]),
                        ],
                        ["part", "segment_no", "place", "doc_id", "local_start", "n_tokens", "ids"],
                    )


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file table: part, segment_no, place (in the segment), doc_id, local_start, n_tokens, ids (binary)."""
    return spark.read.schema(FILE_SCHEMA).parquet(path).select("part", "segment_no", "segment").mapInArrow(_documents, READ_SCHEMA)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """ids before each segment: totals of the parts are summed up first, and they are as many as the writing tasks."""
    sizes = spark.read.schema(FILE_SCHEMA).parquet(path).select("part", "segment_no", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("segment_no").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "segment_no", (F.col("before_part") + F.col("inside")).alias("segment_start")
    )
