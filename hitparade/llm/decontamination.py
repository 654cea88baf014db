"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

Words are runs of ASCII letters in lower case, digits and all characters beyond ASCII. A window is `window` consecutive
words of an item; an item of fewer words, but not none, is one window.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from hitparade.llm import words
from hitparade.llm.spans import as_rows, cut_out
from hitparade.llm.stored import stored

#: Words of items in one automaton at most, or one item of more words; more items take another one, over the same documents.
AUTOMATON_WORDS = 200_000

#: Letters in lower case, and a space for whatever is not in a word.
FOLDED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def folded(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLDED).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in own]) for i, own in items if own]
        for _, sequence in coded:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        #: Items by state and length of a window: a state and a length name one word sequence.
        self.windows: dict[tuple[int, int], set[str]] = {}
        for item, sequence in coded:
            size = min(window, len(sequence))
            for _, state, _ in self.matches(sequence, size):
                self.windows.setdefault((self._state_of(state, size), size), set()).add(item)
        self.sizes = sorted({size for _, size in self.windows})

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, word, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            target = self.next[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._clone(at, word, target)
        return new

    def _state(self, length: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[target]))
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def matches(self, sequence: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """Place, state and length of the longest match that ends at each place, where it has at least `least` words."""
        state = length = 0
        for place, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            if length >= least:
                yield place, state, length

    def _state_of(self, state: int, size: int) -> int:
        """The state of the last `size` words of a match in this state."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def hits(self, sequence: list[int]) -> tuple[list[tuple[int, int]], set[str], int]:
        """First and last places of the windows in the sequence, the items that have them, and the longest match."""
        found, items, longest = [], set(), 0
        for place, state, length in self.matches(sequence, self.sizes[0]):
            for size in self.sizes:
                if size > length:
                    break
                own = self.windows.get((self._state_of(state, size), size))
                if own:
                    found.append((place - size + 1, place))
                    items |= own
                    longest = max(longest, length)
        return found, items, longest


@lru_cache(maxsize=2)
def _built(items: tuple, window: int) -> Automaton:
    return Automaton([(i, folded(text)) for i, text in items], window)


def _joined(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _scan(shared, window: int, schema: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(shared.value, window)
        for batch in words.slices(batches):
            texts = words.texts_of(batch)
            codes, offsets, distinct = words.split(words.translated(texts, FOLDED))
            known = automaton.vocabulary
            own = np.fromiter((known.get(w.encode(), -1) for w in distinct.to_pylist()), np.int64, len(distinct))[codes]
            spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
            items: list[set[str]] = [set() for _ in range(len(texts))]
            longest = [0] * len(texts)
            # Runs of known words within a text that can hold a window; elsewhere the automaton is at its root.
            inside = np.r_[False, own >= 0, False]
            cut_here = np.zeros(len(own) + 1, bool)
            cut_here[offsets] = True
            begins = np.flatnonzero(inside[1:-1] & (cut_here[:-1] | ~inside[:-2]))
            ends = np.flatnonzero(inside[1:-1] & (cut_here[1:] | ~inside[2:])) + 1
            long = ends - begins >= (automaton.sizes[0] if automaton.sizes else len(own) + 1)
            begins, ends = begins[long], ends[long]
            owner = np.searchsorted(offsets, begins, "right") - 1
            for begin, end, row in zip(begins.tolist(), ends.tolist(), owner.tolist()):
                found, which, most = automaton.hits(own[begin:end].tolist())
                base = begin - int(offsets[row])
                spans[row] += [(base + a, base + b) for a, b in found]
                items[row] |= which
                longest[row] = max(longest[row], most)
            columns = {name: batch.column(name) for name in batch.schema.names}
            before_spans, before_items, before_longest = (batch.column(c).to_pylist() for c in ("spans", "items", "longest"))
            located = []
            for row, new in enumerate(spans):
                if not new:
                    located.append(before_spans[row])
                    continue
                all_spans = _joined(new + [(s["first"], s["last"]) for s in before_spans[row]])
                at = [m.span() for m in WORD.finditer(texts[row].as_py())]
                located.append([{"first": a, "last": b, "start": at[a][0], "end": at[b][1]} for a, b in all_spans])
            columns["n_words"] = pa.array(np.diff(offsets))
            columns["spans"] = pa.array(located, schema.field("spans").type)
            columns["items"] = pa.array([sorted({*a, *b}) for a, b in zip(items, before_items)], schema.field("items").type)
            columns["longest"] = pa.array([max(a, b) for a, b in zip(longest, before_longest)], pa.int32())
            yield pa.record_batch([columns[name] for name in schema.names], schema.names)

    return scan


def _grouped(items: DataFrame) -> Iterator[tuple[tuple[str, str], ...]]:
    """Items by running size. The driver holds one partition and one group at a time; without items the group is empty."""
    group, n = [], 0
    for row in items.toLocalIterator():
        size = len(folded(row["text"]))
        if group and n + size > AUTOMATON_WORDS:
            yield tuple(sorted(group))
            group, n = [], 0
        group.append((row["item"], row["text"]))
        n += size
    yield tuple(sorted(group))


def scanned(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Each document as the struct row, with n_words, the spans of hit words (first and last word, start and end in code
    points), the items whose windows occur, the longest match of those that hold a window, and n_hit.

    Documents are streamed through the automaton where they lie, without a shuffle. Distinct items go to the tasks in groups of
    at most AUTOMATON_WORDS words or one item, one automaton after the other. Groups are broadcast rather than read from the
    shared folder, which may be in a store that only Spark reads; each is one more pass over the documents. Null texts have no words, and items without words have no windows. Items that repeat an id count as one item with the windows of all;
    items without id are left out. Rows of documents that repeat each get their own result.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    items = stored(items.where("item is not null and text is not null").distinct(), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = as_rows(documents).select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:int,last:int,start:int,end:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
        F.lit(0).alias("longest"),
    )
    for own in _grouped(items.repartition(1 + size // (6 * AUTOMATON_WORDS))):
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(own), window, to_arrow_schema(rows.schema)), rows.schema)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return rows.withColumn("n_hit", hit)


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10, most_percent: int = 50) -> DataFrame:
    """The documents with all hit spans cut out; those of which more than most_percent of the words are hit go.

    All columns stay, and n_chars, where there is one, follows the text. Documents without a hit stay as they are.
    """
    found = scanned(documents, benchmark, window).where(100 * F.col("n_hit") <= most_percent * F.col("n_words"))
    return cut_out(found, documents)
