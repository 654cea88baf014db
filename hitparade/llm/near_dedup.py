"""Near-duplicates by HyperMinHash: compressed registers in bands, a corrected estimate, then the full shingle sets.

Words are runs of other characters than ASCII white space, with A-Z in lower case. A document's set has its distinct
shingles of `size` consecutive words; with fewer words, the whole sequence as one. Shingles are compared by 64-bit hashes.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitparade.llm import words
from hitparade.llm.components import components
from hitparade.llm.stored import by_shuffle, stored

#: A shingle's hash names one of 2**BUCKET_BITS registers and a value; a register keeps its smallest value as the number of
#: leading zeros and MANTISSA_BITS bits after the first one: 16 bits in all.
BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
VALUE_BITS = 64 - BUCKET_BITS
MANTISSA_BITS = 10
#: Registers to a band. A pair of similarity 0.8 shares none of the 32 bands with probability (1 - 0.8**4)**32 < 5e-8.
BAND = 4
#: Pairs go on to the full sets if their estimate is at most so far below the threshold: seven standard deviations.
MARGIN = 0.25
#: Random places that an empty register tries to borrow from before it takes the next filled one.
TRIES = 64

#: Bytes of text worked on at a time: short texts have registers of many times their size.
SLICE_BYTES = 2 << 20
#: Rows of ids that are broadcast at most: about 10 MB.
SENT_ROWS = 250_000

LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
SKETCH = "doc_id long, n_shingles long, set_key binary, registers binary"


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The rising hashes of each text's shingles."""
    codes, offsets, distinct = words.split(words.translated(texts, LOWER))
    word_hashes = words.hashes(distinct)[codes] if len(codes) else np.empty(0, np.uint64)
    runs = words.run_hashes(word_hashes, size)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if end - start >= size:
            yield np.unique(runs[start : end - size + 1])
        else:
            yield words.run_hashes(word_hashes[start:end], end - start) if end > start else np.empty(0, np.uint64)


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    tries, place = np.meshgrid(np.arange(TRIES), np.arange(REGISTERS), indexing="ij")
    return (words.mix((tries * REGISTERS + place + 1).astype(np.uint64)) >> np.uint64(VALUE_BITS)).astype(np.int64)


def compressed(values: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of numbers of VALUE_BITS bits."""
    bits = np.frexp(values.astype(np.float64))[1]
    shift = bits - 1 - MANTISSA_BITS
    up, down = np.maximum(-shift, 0).astype(np.uint64), np.maximum(shift, 0).astype(np.uint64)
    mantissa = ((values >> down) << up) & np.uint64((1 << MANTISSA_BITS) - 1)
    zeros = np.maximum(VALUE_BITS - bits, 0).astype(np.uint64)
    return ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of non-empty sets, a row each. Empty registers borrow from filled ones, at places that depend on the
    register alone, so that equal registers stay as likely as their sets are alike, also for small sets."""
    edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(VALUE_BITS)
    values = np.zeros((len(sets), REGISTERS), np.uint64)
    filled = np.zeros((len(sets), REGISTERS), bool)
    for row, own in enumerate(sets):
        first = np.searchsorted(own, edges)
        filled[row] = np.r_[first[1:], len(own)] > first
        values[row, filled[row]] = own[first[filled[row]]]
    kept = compressed(values & np.uint64((1 << VALUE_BITS) - 1))
    out, empty = kept.copy(), ~filled
    for donor in _donors():
        rows = np.flatnonzero(empty.any(axis=1))
        if not len(rows):
            return out
        borrow = empty[rows] & filled[rows][:, donor]
        out[rows] = np.where(borrow, kept[rows][:, donor], out[rows])
        empty[rows] &= ~borrow
    for row in np.flatnonzero(empty.any(axis=1)):
        places = np.flatnonzero(filled[row])
        need = np.flatnonzero(empty[row])
        out[row, need] = kept[row, places[np.searchsorted(places, need) % len(places)]]
    return out


def _sketch(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, SLICE_BYTES):
            sets = list(shingle_sets(batch.column("text"), size))
            there = [i for i, own in enumerate(sets) if len(own)]
            keys: list[bytes | None] = [None] * len(sets)
            coded: list[bytes | None] = [None] * len(sets)
            for i, row in zip(there, registers([sets[i] for i in there])):
                keys[i], coded[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), row.astype("<u2").tobytes()
            columns = [batch.column("doc_id"), pa.array([len(own) for own in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(coded, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "n_shingles", "set_key", "registers"])

    return sketch


def sketches(documents: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, set_key (a 128-bit digest of the set) and registers; the last two are null for empty sets."""
    return _narrow(documents).mapInArrow(_sketch(size), SKETCH)


def _narrow(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


@lru_cache(maxsize=1)
def _accidental() -> np.ndarray:
    """How often two registers of disjoint sets agree, for 2**0, 2**1, ... values to a register."""
    zeros, mantissa = np.meshgrid(np.arange(VALUE_BITS), np.arange(1 << MANTISSA_BITS), indexing="ij")
    low = 2.0 ** -(zeros + 1) * (1 + mantissa / (1 << MANTISSA_BITS))
    high = 2.0 ** -(zeros + 1) * (1 + (mantissa + 1) / (1 << MANTISSA_BITS))
    out = []
    for n in 2.0 ** np.arange(40):
        p = np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(high, 1 - 1e-16)))
        out.append(float((p * p).sum()))
    return np.array(out)


def estimate(agreeing: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of registers that agree, less those that agree by accident."""
    each = np.maximum(np.sqrt(n_a.astype(float) * n_b) / REGISTERS, 1)
    accident = np.interp(np.log2(each), np.arange(40), _accidental())
    return np.clip((agreeing / REGISTERS - accident) / (1 - accident), 0, 1)


def _sides(pairs: DataFrame, table: DataFrame, key: str, *columns: str) -> DataFrame:
    """The pairs with the columns of table for a and for b: one join over both sides, so that table moves once."""
    asked = [pairs.select(F.col(side).alias(key), "a", "b", F.lit(side).alias("side")) for side in ("a", "b")]
    joined = asked[0].unionByName(asked[1]).join(by_shuffle(table), key)
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{c}_{side}")
    return joined.groupBy("a", "b").agg(*(of(side, c) for c in columns for side in ("a", "b")))


def _likely(least: float):
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            rows = [np.frombuffer(b"".join(batch.column(f"registers_{s}").to_pylist()), "<u2").reshape(n, REGISTERS) for s in ("a", "b")]
            sizes = [batch.column(f"n_shingles_{s}").to_numpy() for s in ("a", "b")]
            chosen = estimate((rows[0] == rows[1]).sum(axis=1), *sizes) >= least
            yield batch.select(["a", "b", "doc_a", "doc_b"]).filter(pa.array(chosen))

    return likely


def _verified(size: int, percent: int):
    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            bytes_ = sum(_list_bytes(whole.column(f"texts_{s}")) for s in ("a", "b"))
            for batch in words.runs(whole, bytes_):
                # One text a side, unless rows repeat a doc_id with other texts. Each distinct text is cut up once.
                sides = [batch.column(f"texts_{s}") for s in ("a", "b")]
                coded = pa.concat_arrays([side.flatten() for side in sides]).dictionary_encode()
                sets = list(shingle_sets(coded.dictionary, size))
                codes = coded.indices.to_pylist()
                ends = np.cumsum([0, *(n for side in sides for n in pc.list_value_length(side).to_pylist())]).tolist()
                n = batch.num_rows
                own = [[codes[ends[i] : ends[i + 1]] for i in range(first, first + n)] for first in (0, n)]
                linked = [any(alike(sets[x], sets[y]) for x in xs for y in ys) for xs, ys in zip(*own)]
                yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verified


def _list_bytes(lists: pa.Array) -> np.ndarray:
    """Bytes of the texts in each list."""
    total = np.r_[0, np.cumsum(pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False))]
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return np.diff(total[np.r_[0, ends]])


def _texts(asked: DataFrame, documents: DataFrame) -> DataFrame:
    """asked (doc_id and other columns) with the texts. Up to SENT_ROWS rows of ids are sent to the texts; more are joined
    by a shuffle."""
    asked = stored(asked, "asked")
    return _narrow(documents).join(F.broadcast(asked) if asked.count() <= SENT_ROWS else by_shuffle(asked), "doc_id")


def _exploded(size: int):
    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, SLICE_BYTES):
            sets = list(shingle_sets(batch.column("text"), size))
            counts = np.array([len(own) for own in sets], np.int64)
            owner = pa.array(np.repeat(np.arange(len(sets)), counts))
            shingles = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            columns = [*(batch.column(c).take(owner) for c in ("node", "label", "text_hash")), pa.array(np.repeat(counts, counts)), pa.array(shingles)]
            yield pa.record_batch(columns, ["node", "label", "text_hash", "size", "shingle"])

    return exploded


def _prefix_pairs(rest: DataFrame, documents: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of nodes (a, b) with different labels that share a shingle among their rarest, where its places in both orders
    leave room for enough others. rest has node, label and doc."""
    texts = _texts(rest.select(F.col("doc").alias("doc_id"), "node", "label"), documents)
    texts = texts.select("node", "label", F.xxhash64("text").alias("text_hash"), "text").distinct()
    found = texts.mapInArrow(_exploded(size), "node long, label long, text_hash long, size long, shingle long")
    found = stored(found, "shingles")
    # Shingles of one text come first in its order and join nothing, so only the others move.
    often = found.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    own = Window.partitionBy("node", "text_hash")
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "shingle")) - 1
    shared = found.join(by_shuffle(often), "shingle").withColumn("place", place)
    prefix = stored(shared.where(100 * F.col("place") <= (100 - percent) * F.col("size")), "prefixes")
    side = lambda s: prefix.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "size", "place")))
    a, b = F.col("size_a"), F.col("size_b")
    room = F.least(a - F.col("place_a"), b - F.col("place_b"))
    enough = (100 + percent) * room >= percent * (a + b)
    ratio = (100 * a >= percent * b) & (100 * b >= percent * a)
    across = (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b"))
    joined = side("a").join(by_shuffle(side("b")), "shingle").where(across & ratio & enough)
    return joined.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _links(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b: nodes) whose full sets are similar enough."""
    rated = _sides(pairs, nodes, "node", "registers", "n_shingles", "doc")
    likely = stored(rated.mapInArrow(_likely(percent / 100 - MARGIN), "a long, b long, doc_a long, doc_b long"), "likely")
    asked = [likely.select(F.col(f"doc_{s}").alias("doc_id"), "a", "b", F.lit(s).alias("side")) for s in ("a", "b")]
    texts = _texts(asked[0].unionByName(asked[1]), documents)
    of = lambda side: F.collect_set(F.when(F.col("side") == side, F.col("text"))).alias(f"texts_{side}")
    return stored(texts.groupBy("a", "b").agg(of("a"), of("b")).mapInArrow(_verified(size, percent), "a long, b long"), "links")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node and label of the members of buckets of three and more that are in several components."""
    rows = members.where("n > 2").join(by_shuffle(labels), "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    several = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    return stored(rows.join(by_shuffle(several.select("key")), "key"), "open")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (node, label) after more links: components that meet take the label of the smallest."""
    if links.isEmpty():
        return labels
    of = lambda side: by_shuffle(labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}")))
    label = lambda side: F.coalesce(F.col(f"label_{side}"), F.col(side)).alias(side)
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(label("a"), label("b"))
    found = components(between).select(F.col("node").alias("label"), F.col("label").alias("to"))
    changed = labels.join(by_shuffle(found), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    new = found.where("label != to").select(F.col("label").alias("node"), F.col("to").alias("label"))
    new = new.join(by_shuffle(labels.select("node")), "node", "left_anti")
    return stored(changed.unionByName(new), "labels")


def components_of(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Documents with 100 * shared >= percent * united shingles are linked; component_id is the smallest doc_id reachable, and
    kept is doc_id = component_id. Empty sets are linked with nothing. Rows without doc_id are linked with nothing, have no
    component_id, and are kept. Rows that repeat a doc_id are the same document.

    Equal sets are first taken together, so groups of copies cost one node. The nodes of a bucket of a band are compared
    with its first node, and with the one that has most links, so a group of near copies costs two comparisons for each
    member and bucket. Where these links leave a bucket in several components, its nodes are joined by their rarest
    shingles: two sets that are similar enough share
    one among so many of their rarest that the rest could not make up the similarity. So no link between components is
    lost, and texts that only share a frequent passage give no pairs.
    """
    found = stored(sketches(documents, size), "sketches")
    sets = found.where("set_key is not null and doc_id is not null").groupBy("set_key")
    nodes = sets.agg(F.min("doc_id").alias("doc"), F.max("registers").alias("registers"), F.max("n_shingles").alias("n_shingles"))
    # Numbered in the order of doc_id, so that the first node of a bucket is the earliest, which copies tend to come from.
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = nodes.repartitionByRange(parts, "doc").sortWithinPartitions("doc")
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    width = 2 * BAND
    slices = F.array(*(F.substring("registers", 1 + width * i, width) for i in range(REGISTERS // BAND)))
    bands = nodes.select("node", F.posexplode(slices).alias("band", "slice"))
    bands = bands.select(F.xxhash64("slice", "band").alias("key"), "node")
    buckets = bands.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    members = stored(bands.join(by_shuffle(buckets), "key"), "members")

    pairs = members.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = _links(pairs, nodes, documents, size, percent)
    labels = components(links)

    # Again with the node of each bucket that has most links so far, for members that are still in another component.
    rest = _open(members, labels)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degrees = ends.groupBy("node").agg(F.count("*").alias("degree"))
    ranked = rest.join(by_shuffle(degrees), "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("last"), "label")).alias("hub"))
    hub = -F.col("hub.last")
    pairs = rest.join(by_shuffle(hubs), "key").where("label != hub.label")
    pairs = pairs.select(F.least(hub, "node").alias("a"), F.greatest(hub, "node").alias("b")).distinct()
    labels = _merged(labels, _links(pairs, nodes, documents, size, percent))

    # What is left in several components is joined by its rarest shingles.
    rest = _open(members, labels).select("node", "label").distinct()
    rest = stored(rest.join(by_shuffle(nodes.select("node", "doc")), "node"), "open")
    across = stored(_prefix_pairs(rest, documents, size, percent), "across")
    labels = _merged(labels, _links(across, nodes, documents, size, percent))

    labelled = nodes.select("set_key", "doc", "node").join(by_shuffle(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("doc").alias("component"))
    by_set = labelled.select("set_key", "label").join(by_shuffle(smallest), "label").select("set_key", "component")
    rows = found.select("doc_id", "n_shingles", "set_key").join(by_shuffle(by_set), "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicated(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each component, the one with the smallest doc_id, and all their columns.

    Rows that repeat a doc_id and are not removed all stay, unless they are alike in doc_id and text: then one stays.
    """
    gone = components_of(documents, size, percent).where("not kept").select("doc_id").distinct()
    left = documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
    repeated = left.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"])
