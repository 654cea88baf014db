"""License scans by patience alignment of templates with texts.

Words are runs of ASCII letters in lower case, digits and all characters beyond ASCII.
"""

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade.llm import words
from hitparade.llm.decontamination import FOLDED, WORD, folded
from hitparade.llm.license_templates import TEMPLATES, entries  # noqa: F401  (the tests read TEMPLATES here)

#: A text has a license if so many percent of the template's words are aligned, all its needed words among them.
COVERAGE = 80
MATCHES = "doc_id long, license string, start int, end int, n_matched int, n_template int, coverage double"


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, which rise in their first place, that rises in the second too."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        if pile == len(tops):
            tops.append(y)
            piles.append(i)
        else:
            tops[pile], piles[pile] = y, i
        before.append(piles[pile - 1] if pile else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Places of equal words by patience: ends that are alike, then words that occur once in both as anchors, the longest
    rising run of these, and the gaps between them in the same way."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = _rising([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place])
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            if anchors:
                todo.append((i + 1, k, j + 1, m))
        out += anchors
    return sorted(out)


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[bytes, ...]
    needed: frozenset
    #: Places of which at least one is aligned in every match: a needed word, or one more than may be missing.
    signals: tuple[int, ...]
    #: Phrases that must not stand in a match, between spaces.
    barred: tuple[bytes, ...]

    @classmethod
    def of(cls, name: str, text: str, needed: tuple[str, ...], barred: tuple[str, ...] = ()) -> "Template":
        own = tuple(folded(text))
        if needed:
            signals = (own.index(needed[0].encode()),)
        else:
            missing = len(own) - -(-len(own) * COVERAGE // 100)
            signals = tuple(sorted(range(len(own)), key=lambda i: (-len(own[i]), i))[: missing + 1])
        return cls(name, own, frozenset(w.encode() for w in needed), signals, tuple(f" {p} ".encode() for p in barred))

    def _allowed(self, found: list[bytes]) -> bool:
        text = b" %s " % b" ".join(found) if self.barred else b""
        return not any(phrase in text for phrase in self.barred)

    def possible(self, counts: Counter) -> bool:
        """False where a text's words, in whatever order, can't cover the template."""
        if any(word not in counts for word in self.needed):
            return False
        return 100 * sum(min(n, counts[word]) for word, n in Counter(self.words).items()) >= COVERAGE * len(self.words)

    def _aligned(self, text: list[bytes], start: int, least: int) -> tuple[int, list[tuple[int, int]]]:
        """The alignment around a place, and where its window begins. The window holds a fifth more than the template on both
        sides. Where outer words of the template are missing, it goes on beyond the aligned ones by that fifth, as long as
        that aligns more, so words put in between lose none but where a fifth of the template's length has none of its own."""
        n = len(self.words)
        slack = max(3, n // 5)
        low, high = max(least, start - slack), min(len(text), start + n + slack)
        pairs = align(list(self.words), text[low:high])
        while pairs:
            # Outer words that are not aligned yet may lie beyond the window.
            wide = max(least, min(low, low + pairs[0][1] - slack)) if pairs[0][0] else low
            far = min(len(text), max(high, low + pairs[-1][1] + 1 + slack)) if pairs[-1][0] < n - 1 else high
            if (wide, far) == (low, high):
                break
            more = align(list(self.words), text[wide:far])
            if len(more) <= len(pairs):
                break
            low, high, pairs = wide, far, more
        return low, pairs

    def matches(self, text: list[bytes], places: dict[bytes, list[int]]) -> list[tuple[int, int, int]]:
        """First and last word and aligned words of each match in a text; places has the places of signal words."""
        n, slack = len(self.words), max(3, len(self.words) // 5)
        found: list[tuple[int, int, int]] = []
        for start in sorted({p - k for k in self.signals for p in places.get(self.words[k], ())}):
            if found and start + slack <= found[-1][1]:
                continue
            low, pairs = self._aligned(text, start, found[-1][1] + 1 if found else 0)
            if 100 * len(pairs) >= COVERAGE * n and self.needed <= {self.words[i] for i, _ in pairs}:
                first, last = low + pairs[0][1], low + pairs[-1][1]
                if self._allowed(text[first : last + 1]):
                    found.append((first, last, len(pairs)))
        return found


@cache
def templates(reserved: bool = False) -> tuple[Template, ...]:
    return tuple(Template.of(*entry) for entry in entries(reserved))


def found_in(text: list[bytes], reserved: bool = False) -> list[tuple[str, int, int, int, int]]:
    """License, first and last word, aligned words and words of the template. Of matches that overlap, the one with more
    aligned words stays, then the one with the larger share, then the first by name."""
    signals = {t.words[k] for t in templates(reserved) for k in t.signals}
    places: dict[bytes, list[int]] = {}
    for i, word in enumerate(text):
        if word in signals:
            places.setdefault(word, []).append(i)
    counts = Counter(text) if places else Counter()
    every = [(t.name, *m, len(t.words)) for t in templates(reserved) if t.possible(counts) for m in t.matches(text, places)]
    kept: list[tuple[str, int, int, int, int]] = []
    for match in sorted(every, key=lambda m: (-m[3], -m[3] / m[4], m[0], m[1])):
        if all(match[2] < other[1] or match[1] > other[2] for other in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: m[1])


def _scan(reserved: bool):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signals = {t.words[k].decode() for t in templates(reserved) for k in t.signals}
        for batch in words.slices(batches):
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            codes, offsets, distinct = words.split(words.translated(texts, FOLDED))
            signal = np.fromiter((w in signals for w in distinct.to_pylist()), bool, len(distinct))[codes]
            rows = []
            for row in np.unique(np.searchsorted(offsets, np.flatnonzero(signal), "right") - 1).tolist():
                text = texts[row].as_py()
                matches = found_in(folded(text), reserved)
                at = [m.span() for m in WORD.finditer(text)] if matches else []
                for name, first, last, matched, size in matches:
                    rows.append((doc_ids[row].as_py(), name, at[first][0], at[last][1], matched, size, matched / size))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            columns = zip(*rows) if rows else [[]] * len(kinds)
            names = [f.split()[0] for f in MATCHES.split(", ")]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return found


def scan(documents: DataFrame, reserved: bool = False) -> DataFrame:
    """Every license found: doc_id, license, start and end in code points, aligned words, words of the template, coverage.

    Whole texts are scanned where they lie, without a shuffle. A text without a signal word of a template cannot cover it;
    around each signal word the template is aligned with as many words as it has and a fifth more to both sides, and further
    as long as that aligns more of it. Null and empty texts have no license; rows that repeat each give their own. reserved lists 'All rights reserved' and its like too.
    """
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(_scan(reserved), MATCHES)
