"""Removal of repeated passages with sparse suffix arrays.

A passage repeats if `length` consecutive words of it stand at an earlier place: in a document with a smaller doc_id, or
further up in the same one. Words are runs of other characters than ASCII white space.

Suffixes are kept only where a minimiser lies: the smallest hash of GRAM words among the first SPREAD places of a window of
`length` words. Equal windows have their minimiser at the same place, and the suffix from there shares at least
length - SPREAD + 1 words. The suffixes are sorted by a hash of these words, and neighbours are compared: those that have an
equal one are extended, to the left to the first window whose minimiser they are and to the right to the end of the last.
Extents that are equal as a whole are settled at once; what differs, as at the ends of a passage, is compared window by
window, so that every window is found, whichever of its group it equals.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade.llm import words
from hitparade.llm.spans import as_rows, cut_out
from hitparade.llm.stored import stored

LENGTH = 50
SPREAD = 30
GRAM = 8

#: Bytes of text worked on at a time: a word takes some 150 bytes on the way.
SLICE_BYTES = 2 << 20

SUFFIXES = "doc_id long, prefix long, place int, whole binary, text_hash long, n_words int, n_chars int"
NEIGHBOURS = "doc_id long, text_hash long, prefix long, place int, edge boolean, open boolean"
RUNS = "doc_id long, text_hash long, first int, n int, start int, end int, high long, low int, windows binary, chars binary"
WINDOWS = "doc_id long, text_hash long, place int, start int, end int, high long, low int"
#: A window's two hashes, and its first and last place in code points, as they lie in the bytes of a run.
WINDOW = np.dtype([("high", "<i8"), ("low", "<i4")])
CHARS = np.dtype([("start", "<i4"), ("end", "<i4")])


def _minimisers(word_hashes: np.ndarray, offsets: np.ndarray, length: int, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Each window that lies in one text, by its first word, and the place of its minimiser, both in the flat array."""
    grams = words.run_hashes(word_hashes, GRAM)
    n = len(word_hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    # Smallest of 1, 2, 4, ... keys, then of two overlapping stretches.
    wide, least = 1, keys
    while 2 * wide <= spread:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    least = np.minimum(least[:n], least[spread - wide :][:n])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = words.gathered(offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0))
    return inside, place[inside]


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    codes, offsets, distinct = words.split(texts)
    return (words.hashes(distinct)[codes] if len(codes) else np.empty(0, np.uint64)), offsets


def _suffixes(length: int, spread: int):
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = length - spread + 1
        schema = pa.schema([("doc_id", pa.int64()), ("prefix", pa.int64()), ("place", pa.int32()), ("whole", pa.binary()), ("text_hash", pa.int64()), ("n_words", pa.int32()), ("n_chars", pa.int32())])
        for batch in words.slices(batches, SLICE_BYTES):
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            word_hashes, offsets = _hashed(texts)
            _, place = _minimisers(word_hashes, offsets, length, spread)
            place = np.unique(place)
            prefix = words.run_hashes(word_hashes, kept)[place] if len(place) else np.empty(0, np.uint64)
            owner = np.searchsorted(offsets, place, "right") - 1
            sizes = np.diff(offsets)
            long = np.flatnonzero(sizes >= length)
            wholes = [xxhash.xxh3_128_digest(word_hashes[offsets[i] : offsets[i + 1]].tobytes()) for i in long.tolist()]
            n, m = len(place), len(long)
            own = np.r_[owner, long]
            none = lambda k, kind: pa.nulls(k, kind)
            join = lambda *x: pa.concat_arrays([pa.array(a, k) if not isinstance(a, pa.Array) else a for a, k in x])
            i32, i64 = pa.int32(), pa.int64()
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
            columns = [
                doc_ids.take(pa.array(own)),
                join((prefix.view(np.int64), i64), (none(m, i64), i64)),
                join(((place - offsets[owner]).astype(np.int32), i32), (none(m, i32), i32)),
                join((none(n, pa.binary()), pa.binary()), (wholes, pa.binary())),
                batch.column("text_hash").take(pa.array(own)),
                join((none(n, i32), i32), (sizes[long].astype(np.int32), i32)),
                join((none(n, i32), i32), (lengths[long].astype(np.int32), i32)),
            ]
            yield pa.record_batch(columns, schema=schema)

    return suffixes


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of sorted batches that equal a neighbour in another text or place. Runs that equal the first or the last
    suffix of a batch lie at its edge and may go on in the batch before or after: those of one text and place are open."""
    for batch in batches:
        if not batch.num_rows:
            continue
        prefix, text_hash, place = (batch.column(c).to_numpy() for c in ("prefix", "text_hash", "place"))
        begins = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        ends = np.r_[begins[1:], len(prefix)] - 1
        # Sorted, so a run is of one text and place only if its first and last are.
        keep = (text_hash[begins] != text_hash[ends]) | (place[begins] != place[ends])
        edge = np.zeros(len(begins), bool)
        edge[[0, -1]] = True
        every = lambda flags: pa.array(np.repeat(flags, ends - begins + 1))
        rows = batch.select(["doc_id", "text_hash", "prefix", "place"])
        yield rows.append_column("edge", every(edge)).append_column("open", every(edge & ~keep)).filter(every(keep | edge))


def _shared(suffixes: DataFrame) -> DataFrame:
    """The suffixes (doc_id, text_hash, prefix, place) whose words stand in another text or at another place, too.

    Suffixes are dealt out by ranges, so that those of a hot passage lie in several tasks, and each compares neighbours in
    the order it has. What lies at the edges of batches is counted by prefix, and only open runs, at most two for each batch,
    are looked up there.
    """
    order = "prefix", "text_hash", "place"
    found = suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, NEIGHBOURS)
    found = stored(found, "neighbours")
    at, own = F.struct("text_hash", "place"), ["doc_id", "text_hash", "prefix", "place"]
    across = found.where("edge").groupBy("prefix").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first != last")
    return found.where("not open").select(*own).unionByName(found.where("open").select(*own).join(across.select("prefix"), "prefix"))


def _runs(length: int, spread: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, SLICE_BYTES):
            doc_ids, texts, places = (batch.column(c) for c in ("doc_id", "text", "places"))
            word_hashes, offsets = _hashed(texts)
            first, place = _minimisers(word_hashes, offsets, length, spread)
            shared = np.zeros(len(word_hashes) + 1, bool)
            counts = pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64)
            shared[places.flatten().to_numpy(zero_copy_only=False) + np.repeat(offsets[:-1], counts)] = True
            keep = shared[place]
            first, place = first[keep], place[keep]
            begins = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)]) if len(first) else first
            sizes = np.diff(np.r_[begins, len(first)])
            windows, chars = np.zeros(len(first), WINDOW), np.zeros(len(first), CHARS)
            owner = np.searchsorted(offsets, first[begins], "right") - 1
            if len(first):
                windows["high"] = words.run_hashes(word_hashes, length)[first].view(np.int64)
                other = words.run_hashes(words.mix(word_hashes + np.uint64(1)), length)[first]
                windows["low"] = (other >> np.uint64(32)).astype(np.uint32).view(np.int32)
                starts, ends = (np.concatenate(x) for x in zip(*(word_spans(t or "") for t in texts.to_pylist())))
                chars["start"], chars["end"] = starts[first], ends[first + length - 1]
            cuts = np.r_[0, np.cumsum(sizes)].tolist()
            own, places_ = ([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (windows, chars))
            digests = [xxhash.xxh3_128_digest(x) for x in own]
            keys = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2) if own else np.zeros((0, 2), np.int64)
            rows = pa.array(owner)
            columns = [
                doc_ids.take(rows),
                batch.column("text_hash").take(rows),
                pa.array((first[begins] - offsets[owner]).astype(np.int32)),
                pa.array(sizes.astype(np.int32)),
                pa.array(chars["start"][begins]),
                pa.array(chars["end"][begins + sizes - 1]),
                pa.array(np.ascontiguousarray(keys[:, 0])),
                pa.array((keys[:, 1] >> 32).astype(np.int32)),
                pa.array(own, pa.binary()),
                pa.array(places_, pa.binary()),
            ]
            yield pa.record_batch(columns, [f.split()[0] for f in RUNS.split(", ")])

    return runs


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of runs, one row each."""
    for batch in batches:
        n = batch.column("n").to_numpy().astype(np.int64)
        owner = pa.array(np.repeat(np.arange(len(n)), n))
        windows, chars = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind) for c, kind in (("windows", WINDOW), ("chars", CHARS)))
        place = words.gathered(batch.column("first").to_numpy().astype(np.int64), n).astype(np.int32)
        numbers = place, chars["start"].copy(), chars["end"].copy(), windows["high"].copy(), windows["low"].copy()
        columns = [batch.column("doc_id").take(owner), batch.column("text_hash").take(owner), *map(pa.array, numbers)]
        yield pa.record_batch(columns, [f.split()[0] for f in WINDOWS.split(", ")])


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    word = np.r_[False, (points != 0x20) & ((points < 0x09) | (points > 0x0D)), False]
    return np.flatnonzero(~word[:-1] & word[1:]), np.flatnonzero(word[:-1] & ~word[1:])


SPANS = "doc_id long, text_hash long, first_word int, end_word int, start int, end int, kept_doc_id long, kept_word int"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covers that touch or overlap as one span, with what the first of them repeats."""
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int32()]
    for batch in batches:
        rows = []
        for doc_id, text_hash, covers in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "covers"))):
            spans: list[list] = []
            for c in sorted(covers, key=lambda c: (c["first"], -c["stop"])):
                if spans and c["first"] <= spans[-1][3]:
                    if c["stop"] > spans[-1][3]:
                        spans[-1][3], spans[-1][5] = c["stop"], c["end"]
                else:
                    spans.append([doc_id, text_hash, c["first"], c["stop"], c["start"], c["end"], c["kept"]["doc_id"], c["kept"]["first"]])
            rows += spans
        columns = zip(*rows) if rows else [[]] * len(kinds)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in SPANS.split(", ")])


def repeated(documents: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """The spans that repeat an earlier place: doc_id, text_hash, first_word, end_word, start and end in code points, and the
    earliest place of the first window (kept_doc_id, kept_word).

    Documents of the same words as an earlier one are one span as a whole and need no windows. The order of places is that
    of doc_id (none is the smallest), a hash of the text, and the word, so rows that repeat a doc_id with another text are
    compared like other documents, and equal rows are the same place. Groups are counted before the shuffle, and a group
    gives one row for each of its members, so a passage in a third of all documents needs no task of its own. Null texts
    and texts of fewer than `length` words have no windows. The places and spans of one id and text are collected: at most
    one for each of its words. Texts move once, to meet the places that are asked of them.
    """
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = chosen.withColumn("text_hash", F.xxhash64("text"))
    found = stored(chosen.mapInArrow(_suffixes(length, spread), SUFFIXES), "suffixes")

    place = F.struct("doc_id", "text_hash")
    wholes = found.where("whole is not null").select("whole", "doc_id", "text_hash", "n_words", "n_chars")
    first = wholes.groupBy("whole").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    copies = stored(wholes.join(first, "whole").where(place != F.col("first")), "copies")
    as_spans = copies.select(
        "doc_id", "text_hash", F.lit(0).alias("first_word"), F.col("n_words").alias("end_word"), F.lit(0).alias("start"),
        F.col("n_chars").alias("end"), F.col("first.doc_id").alias("kept_doc_id"), F.lit(0).alias("kept_word"),
    ).distinct()

    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    gone = copies.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash")).distinct()
    shared = _shared(found.where("prefix is not null").select("prefix", "doc_id", "text_hash", "place")).join(gone, same, "left_anti")
    places = shared.groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash")).agg(F.collect_set("place").alias("places"))
    runs = chosen.join(places, same).drop("of", "of_hash").mapInArrow(_runs(length, spread), RUNS)
    runs = stored(runs, "runs")

    # Runs that are equal as a whole repeat the first of them; the earliest place of any window is in one that is first.
    key, at = ["high", "low"], F.struct("doc_id", "text_hash", "first")
    firsts = runs.groupBy(*key).agg(F.min(at).alias("kept"), F.count("*").alias("size")).where("size > 1").drop("size")
    firsts = stored(firsts, "firsts")
    covers = runs.drop("windows", "chars").join(firsts, key).where(at != F.col("kept"))
    covers = covers.select("doc_id", "text_hash", "first", (F.col("first") + F.col("n") + length - 1).alias("stop"), "start", "end", "kept")
    fresh = runs.join(firsts, key, "left").where(F.col("kept").isNull() | (at == F.col("kept"))).drop("kept", *key)
    windows = stored(fresh.mapInArrow(_exploded, WINDOWS), "windows")
    at = F.struct("doc_id", "text_hash", F.col("place").alias("first"))
    groups = windows.groupBy(*key).agg(F.min(at).alias("kept"), F.count("*").alias("size")).where("size > 1").drop("size")
    again = windows.join(groups, key).where(at != F.col("kept"))
    again = again.select("doc_id", "text_hash", F.col("place").alias("first"), (F.col("place") + length).alias("stop"), "start", "end", "kept")

    cover = F.struct("first", "stop", "start", "end", "kept").alias("cover")
    every = covers.unionByName(again).select("doc_id", "text_hash", cover).distinct()
    spans = every.groupBy("doc_id", "text_hash").agg(F.collect_list("cover").alias("covers")).mapInArrow(_merged, SPANS)
    return spans.unionByName(as_spans)


def deduplicated(documents: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """The documents without their repeated passages; those that hold nothing else than white space afterwards go."""
    spans = repeated(documents, length, spread)
    own = spans.groupBy(F.col("doc_id").alias("of"), "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("of")) & (F.xxhash64("row.text") == F.col("text_hash"))
    return cut_out(as_rows(documents).join(own, same, "left"), documents, drop_emptied=True)
