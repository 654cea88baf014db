"""Best-fit packing by minimum bin slack.

Pieces are packed by their lengths alone, of which there are at most ``capacity``. For one sequence after the other, a
bitset subset-sum over the lengths still there finds the fullest combination that holds the longest of them. It is used as
often as the numbers of pieces allow before the next one is sought. So the plan grows with the number of lengths, not with
the number of documents, and the driver sees only the counts by length.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitparade.llm import tokens, words
from hitparade.llm.stored import stored

#: Bytes of text encoded at a time: ids and their places take some thirty times as much on the way.
SLICE_BYTES = 1 << 20
PIECES = "part int, row long, doc_id long, piece int, start long, length int, ids binary"


def _pieces(definition, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), 0
        for batch in words.slices(batches, SLICE_BYTES):
            encoder = tokens.encoder(definition.value)
            ids, offsets = tokens.with_end(*encoder.encode(batch.column("text")), end_id)
            sizes = np.diff(offsets)
            counts = -(-sizes // capacity)
            piece = words.gathered(np.zeros(len(counts), np.int64), counts)
            owner = np.repeat(np.arange(len(counts)), counts)
            start = piece * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            bounds = pa.py_buffer((4 * np.r_[0, np.cumsum(length)]).astype("<i4"))
            yield pa.record_batch(
                [
                    pa.array(np.full(len(owner), part, np.int32)),
                    pa.array(np.arange(rows, rows + len(owner))),
                    batch.column("doc_id").take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length.astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(owner), [None, bounds, pa.py_buffer(ids.astype("<u4"))]),
                ],
                ["part", "row", "doc_id", "piece", "start", "length", "ids"],
            )
            rows += len(owner)

    return cut


def pieces(documents: DataFrame, definition: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Every document's ids with end_id, cut where they pass capacity: part, row, doc_id, piece, start, length, ids.

    ids are little-endian unsigned 32-bit integers. part and row name a piece, also where documents repeat a doc_id. Null texts are empty: one piece of the end id alone.
    """
    shared = documents.sparkSession.sparkContext.broadcast(definition)
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(_pieces(shared, end_id, capacity), PIECES)


def fullest(left: dict[int, int], order: list[int], capacity: int) -> dict[int, int]:
    """How often each length is in the fullest combination of the lengths left, one of the longest being in it.

    Bit s of a set says that the sum s can be reached. Lengths come in falling order, each with doubling multiples, until
    the full sum is reached; then the steps are walked back.
    """
    first = order[0]
    room = capacity - first
    reached, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in order:
        if length > room:
            continue
        number, multiple = min(left[length] - (length == first), room // length), 1
        while number > 0 and not reached >> room & 1:
            times = min(multiple, number)
            steps.append((length, times, reached))
            reached |= (reached << length * times) & mask
            number, multiple = number - times, 2 * multiple
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, {first: 1}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            chosen[length] = chosen.get(length, 0) + times
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many sequences take each, so that every piece has a place."""
    left, out = {k: n for k, n in counts.items() if n}, []
    order = sorted(left, reverse=True)
    while order:
        chosen = fullest(left, order, capacity)
        times = min(left[length] // n for length, n in chosen.items())
        out.append((chosen, times))
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
                order.remove(length)
    return out


def _slots(combinations: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: the first rank that each combination takes, pieces of this length in it, first sequence, first offset."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for chosen, times in combinations:
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.setdefault(length, []).append((taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*found)) for length, found in rows.items()}


def _place(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, n, base, begin = shared.value[int(length[own[0]])]
                k = np.searchsorted(first, rank[own], "right") - 1
                within = rank[own] - first[k]
                sequence[own] = base[k] + within // n[k]
                offset[own] = begin[k] + within % n[k] * length[own[0]]
            kept = [batch.column(c) for c in ("part", "row")]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], ["part", "row", "sequence_id", "offset"])

    return place


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """part, row, sequence_id and offset of each piece: as few sequences of at most capacity ids as the combinations give.

    cut has part, row and length, as pieces() makes them; it is read twice, so it should be stored. Pieces of one length are
    ranked within their part, after the pieces of the parts before, so that a length that most pieces share is ranked by
    many tasks. The slots sent to the tasks are a few numbers for each combination: capacity bounds the plan.
    """
    narrow = cut.select("part", "row", "length")
    counted = stored(narrow.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = cut.sparkSession.sparkContext.broadcast(_slots(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "part").orderBy("row")
    ranked = narrow.withColumn("inside", F.row_number().over(inside)).join(starts, ["length", "part"])
    ranked = ranked.select("part", "row", "length", (F.col("before") + F.col("inside") - 1).alias("rank"))
    return ranked.mapInArrow(_place(slots), "part int, row long, sequence_id long, offset long")
