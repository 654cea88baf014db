"""Token counts by rank-synchronous merging over ragged arrays.

A text is cut into units, a piece of text with the one space before it, and units into the pre-tokens of the tokenizer.
The byte symbols of all pre-tokens that a task has not yet seen lie one after the other in one array. In each round every
pre-token merges all places of its pair of lowest rank, all pre-tokens at the same time, until none has a pair left; the
symbols that survive are its tokens.
"""

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hitparade.llm import words

#: Units and pre-tokens that a Python worker remembers before it starts afresh; counts do not depend on it.
REMEMBERED = 800_000

#: Characters whose classes are the same in every version of Unicode, and the pre-tokens of texts made of them.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
KNOWN = re.compile("[\n -~À-ÿ]*").fullmatch
PRE_TOKENS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\n {LETTERS}0-9]+|[\n ]+(?![^\n ])|[\n ]+"
).findall

#: White space before a space; a text with it is one unit, as its space does not begin a pre-token.
SPACED = r"[\t-\r\x{1c}-\x{1f}\x{85}\pZ] "


class Merges:
    """Merge ranks of a byte-level BPE, looked up by pairs of ids."""

    def __init__(self, definition: dict):
        model = definition["model"]
        vocabulary = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocabulary[x] for x in column], np.int64) for column in (*zip(*pairs), ["".join(p) for p in pairs]))
        self.none = len(pairs)
        self.base = max(vocabulary.values()) + 1
        self.made = made
        # An open table with linear probing; it is filled all at once, those that find their place taken try the next.
        self.keys, self.ranks, self.bits = left * self.base + right, np.arange(len(pairs)), 18
        self.table_keys = np.full(1 << self.bits, -1, np.int64)
        self.table_ranks = np.full(1 << self.bits, self.none, np.int64)
        waiting, slot = np.arange(len(pairs)), self._slot(self.keys)
        while len(waiting):
            free = self.table_keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = first[free[first]]
            self.table_keys[slot[put]], self.table_ranks[slot[put]] = self.keys[waiting[put]], waiting[put]
            rest = np.setdiff1d(np.arange(len(waiting)), put)
            waiting, slot = waiting[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (words.mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.base + right
        slot = self._slot(keys)
        found = self.table_keys[slot]
        out = np.where(found == keys, self.table_ranks[slot], self.none)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        at = slot[open_]
        while len(open_):
            at = (at + 1) & ((1 << self.bits) - 1)
            found = self.table_keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.table_ranks[at[hit]]
            more = ~hit & (found >= 0)
            open_, at = open_[more], at[more]
        return out

    def counts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols that survive of each run."""
        out = np.zeros(len(lengths), np.int64)
        runs = np.flatnonzero(lengths)
        lengths = lengths[runs]
        owner = np.repeat(np.arange(len(runs)), lengths)
        ranks = self._pairs(symbols, owner)
        while len(runs):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == self.none
            if done.any():
                out[runs[done]] = lengths[done]
                stay = ~done[owner]
                symbols, ranks = symbols[stay], ranks[stay]
                runs, lengths, lowest = runs[~done], lengths[~done], lowest[~done]
                if not len(runs):
                    break
                owner = np.repeat(np.arange(len(runs)), lengths)
            merge = np.flatnonzero(ranks == lowest[owner])
            # Of places that overlap, as in a a a, every second one counted from the first.
            new = np.r_[True, np.diff(merge) > 1]
            number = np.arange(len(merge)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            merge = merge[number % 2 == 0]
            symbols[merge] = self.made[ranks[merge]]
            keep = np.ones(len(symbols), bool)
            keep[merge + 1] = False
            moved = merge - np.arange(len(merge))
            symbols, ranks, owner = symbols[keep], ranks[keep], owner[keep]
            lengths = np.bincount(owner, minlength=len(runs))
            for at in (moved - 1, moved):
                at = at[at >= 0]
                ranks[at] = self._rank_at(symbols, owner, at)
        return out

    def _rank_at(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(symbols) - 1)
        together = (owner[at] == owner[after]) & (after > at)
        return np.where(together, self.rank(symbols[at], symbols[after]), self.none)

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self._rank_at(symbols, owner, np.arange(len(symbols)))


class Counter:
    """Token counts of texts; definition is the JSON of a byte-level BPE tokenizer without normalizer."""

    def __init__(self, definition: str):
        self.definition = json.loads(definition)
        if self.definition["normalizer"] or self.definition["model"].get("ignore_merges"):
            raise ValueError("a byte-level BPE without normalizer is needed")
        self.tokenizer = Tokenizer.from_str(definition)
        self.merges = Merges(self.definition)
        vocabulary = self.definition["model"]["vocab"]
        level = self.tokenizer.pre_tokenizer
        # The symbol of each byte: the pre-tokenizer shows it for characters whose UTF-8 has that byte.
        self.symbol = np.zeros(256, np.int64)
        for c in (*range(0x800), 0x800, *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x40000)):
            if not 0xD800 <= c < 0xE000:
                shown = "".join(x for x, _ in level.pre_tokenize_str(chr(c)))
                for byte, x in zip(chr(c).encode(), shown):
                    self.symbol[byte] = vocabulary[x]
        special = [t["content"] for t in self.definition["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pre_tokens: dict[str, int] = {}
        self.letters: dict[str, int] = {}
        self.marks: dict[str, int] = {}
        self.others: dict[str, int] = {}

    def _cut(self, text: str) -> tuple[int, list[str]]:
        """Special strings in the text, and the pre-tokens of what is between them."""
        number, parts = 0, [text]
        if self.special:
            parts = self.special.split(text)
            number = len(parts) - 1
        out: list[str] = []
        for part in parts:
            if KNOWN(part):
                out += PRE_TOKENS(part)
            else:
                out += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return number, out

    def _merged(self, pre_tokens: list[str]) -> list[int]:
        out: list[int] = []
        for at in range(0, len(pre_tokens), 200_000):
            coded = [x.encode() for x in pre_tokens[at : at + 200_000]]
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            symbols = self.symbol[np.frombuffer(b"".join(coded), np.uint8)]
            out += self.merges.counts(symbols, lengths).tolist()
        return out

    def _words(self, letters: list[str]) -> list[int]:
        return self._merged([" " + x for x in letters])

    def _whole(self, units: list[str]) -> list[int]:
        cut = [self._cut(unit) for unit in units]
        known = self.pre_tokens
        new = list({x for _, found in cut for x in found if x not in known})
        known.update(zip(new, self._merged(new)))
        return [number + sum(map(known.__getitem__, found)) for number, found in cut]

    def _spaced(self, units: list[str]) -> list[int]:
        return self._whole([" " + x for x in units])

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null texts have none."""
        memories = self.pre_tokens, self.letters, self.marks, self.others
        if sum(map(len, memories)) > REMEMBERED:
            for memory in memories:
                memory.clear()
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, SPACED).to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        if whole.any():
            out[whole] = self._whole(texts.filter(pa.array(whole)).to_pylist())
        if whole.all():
            return out
        lists = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        coded = lists.values.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        codes, offsets = codes[offsets[0] : offsets[-1]], offsets - offsets[0]
        # Letters with a space before them and closing marks are two pre-tokens.
        units = coded.dictionary
        plain, letters, marks = words.plain_parts(units)
        sizes = np.zeros(len(units), np.int64)
        for found in (words.looked_up(letters, self.letters, self._words), words.looked_up(marks, self.marks, self._whole)):
            sizes[plain] += np.array(found[0], np.int64)[found[1]] if len(found[0]) else 0
        values, place = words.looked_up(units.filter(pa.array(~plain)), self.others, self._spaced)
        sizes[~plain] = np.array(values, np.int64)[place]
        # The first unit of a text has no space before it.
        first = codes[offsets[:-1]]
        heads, place = np.unique(first, return_inverse=True)
        bare = np.array(self._whole(units.take(pa.array(heads)).to_pylist()), np.int64)
        total = np.r_[0, np.cumsum(sizes[codes])]
        out[~whole] = total[offsets[1:]] - total[offsets[:-1]] - sizes[first] + bare[place]
        return out


@lru_cache(maxsize=2)
def counter(definition: str) -> Counter:
    """One for all tasks of a Python worker."""
    return Counter(definition)


def _counted(definition):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            texts = batch.column("text")
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = pa.array(counter(definition.value).counts(texts))
            yield pa.record_batch([batch.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    return count


def token_counts(documents: DataFrame, definition: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row, in one pass without a shuffle.

    definition is the JSON of a byte-level BPE tokenizer. Null texts are empty; rows that repeat stay as they are.
    """
    shared = documents.sparkSession.sparkContext.broadcast(definition)
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = chosen.mapInArrow(_counted(shared), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
