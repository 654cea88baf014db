"""What the queries must give, worked out row by row in plain Python. documents is a list of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

LOWER = {c: c + 32 for c in range(65, 91)}


def spaced(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def tokenizer(name):
    return Tokenizer.from_str(Path(public_tokenizers.path(name)).read_text())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def token_files(documents):
    encoder, start, out = tokenizer("word_bpe_49k.json"), 0, []
    for doc_id, text in sorted(documents):
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def pieces(documents, capacity=4096):
    encoder, out = tokenizer("word_bpe_49k.json"), []
    for doc_id, text in documents:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            out.append((doc_id, piece, start, len(own), crc(own)))
    return out


def token_counts(documents, limit=1024):
    encoder = tokenizer("byte_bpe_50k.json")
    sizes = [(i, len((t or "").encode()), len(encoder.encode(t or "", add_special_tokens=False).ids)) for i, t in documents]
    return [(*row, row[2] > limit) for row in sizes]


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontamination(documents, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = benchmark_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(str(item))
    out = []
    for doc_id, text in documents:
        words, hit, found = benchmark_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    found |= own
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def quality_base(documents, size=8):
    out = []
    for doc_id, text in documents:
        words = spaced(text, lower=False)
        lines = [line for line in (text or "").split("\n") if spaced(line)]
        counts = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        covered = {j for i in range(len(words) - size + 1) if counts[tuple(words[i : i + size])] > 1 for j in range(i, i + size)}
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed))
    return out


def first_key(doc_id, *rest):
    """Rows without doc_id come first."""
    return (doc_id is not None, doc_id or 0, *rest)


def repeated_lines(documents, least=1, sentences=False, run=1):
    units = []
    for doc_id, text in documents:
        start = number = place = 0
        for line in (text or "").split("\n"):
            for unit in re.findall(r".*?[.!?](?=[ \t\x0b\x0c\r])|.+", line, re.DOTALL) or [""] if sentences else [line]:
                words = spaced(unit)
                if len(words) >= least:
                    units.append((doc_id, number, start, start + len(unit), len(words), place, " ".join(words)))
                    place += 1
                start, number = start + len(unit), number + 1
            start += 1
    first, runs = {}, defaultdict(int)
    for unit in sorted(units, key=lambda u: first_key(u[0], u[2])):
        first.setdefault(unit[6], (unit[0], unit[2]))
    again = sorted({u for u in units if first[u[6]] != (u[0], u[2])}, key=lambda u: first_key(u[0], u[5]))
    named, last = [], None
    for unit in again:
        name = last[1] if last and last[0] == (unit[0], unit[5] - 1) else unit
        last = (unit[0], unit[5]), name
        named.append((unit, name))
        runs[name] += unit[4]
    return [(*u[:5], *first[u[6]]) for u, name in named if runs[name] >= run]


def repeated_words(documents, length=50):
    """doc_id to the places of words in windows that stand at an earlier place; documents have distinct ids."""
    seen, out = set(), defaultdict(set)
    for doc_id, text in sorted(documents):
        words = spaced(text, lower=False)
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            if key in seen:
                out[doc_id].update(range(i, i + length))
            seen.add(key)
    return dict(out)


def shingles(text, size):
    words = spaced(text)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(documents, size=4, percent=80):
    """Rows of (doc_id, n_shingles, component_id, kept); documents without id are linked with nothing."""
    sets = [(i, shingles(t, size)) for i, t in documents]
    named = sorted({(i, s) for i, s in sets if s and i is not None}, key=lambda x: x[0])
    parent = {i: i for i, _ in named}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(named):
        for j, y in named[:a]:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    out = []
    for i, s in sets:
        component = root(i) if s and i is not None else i if not s else None
        out.append((i, len(s), component, component is None or i == component))
    return out
