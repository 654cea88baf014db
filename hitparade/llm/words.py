"""Words of many texts at once, as flat numpy arrays with the offsets of each text."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: An odd factor and its inverse modulo 2**64, for polynomial hashes of word runs.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)

#: Texts are worked on in slices of about so many bytes, which bounds the memory of a task at any batch size.
SLICE_BYTES = 8 << 20


def texts_of(batch: pa.RecordBatch) -> pa.Array:
    """The column text, or the field text of the column row."""
    return batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("row"), "text")


def slices(batches: Iterator[pa.RecordBatch], slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about slice_bytes of text; a longer text is a run of its own.

    At the end what Arrow holds unused goes back: a worker that waits for its next task should be small.
    """
    for batch in batches:
        yield from runs(batch, pc.fill_null(pc.binary_length(texts_of(batch)), 0).to_numpy(zero_copy_only=False), slice_bytes)
    pa.default_memory_pool().release_unused()


def runs(batch: pa.RecordBatch, sizes: np.ndarray, slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about slice_bytes, by the size of each row."""
    sizes = sizes.astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // slice_bytes
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else []
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(start), int(end - start))


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts, without nulls, with every ASCII byte changed by the table."""
    texts = pc.fill_null(texts, "")
    _, bounds, data = texts.buffers()
    offsets = np.frombuffer(bounds, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data else b""
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(raw.translate(table))])


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: a code for each word, the offsets of the texts, and the words by code.

    Null texts have no words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.values.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    codes, offsets = codes[offsets[0] : offsets[-1]], offsets - offsets[0]
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:
        there = codes != empty
        offsets = np.r_[0, np.cumsum(there)][offsets]
        codes = codes[there]
    return codes, offsets, coded.dictionary


#: Letters whose class and case are the same in every version of Unicode, then closing marks.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*$"


def plain_parts(pieces: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Which pieces are letters with closing marks or none, and of those the letters and the marks."""
    plain = pc.match_substring_regex(pieces, PLAIN)
    chosen = pieces.filter(plain)
    letters = pc.ascii_rtrim(chosen, characters=".,;:!?")
    marks = pc.replace_substring_regex(chosen, "^[^.,;:!?]+", "")
    return plain.to_numpy(zero_copy_only=False), letters, marks


def looked_up(keys: pa.Array, known: dict, more) -> tuple[list, np.ndarray]:
    """Values of the distinct keys, and the place of each key among them. more gives a list of values for new keys."""
    coded = keys.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    values = list(map(known.get, distinct))
    new = [i for i, value in enumerate(values) if value is None]
    for i, value in zip(new, more([distinct[i] for i in new])):
        values[i] = known[distinct[i]] = value
    return values, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def run_hashes(word_hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the length words from each place on; the last length - 1 places have none."""
    n = len(word_hashes)
    if n < length:
        return np.empty(0, np.uint64)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(word_hashes * powers(FACTOR, n), dtype=np.uint64)]
    return mix((sums[length:] - sums[:-length]) * powers(INVERSE, n - length + 1))


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of many runs one after the other: starts[0], starts[0] + 1, ..., starts[1], ..."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
