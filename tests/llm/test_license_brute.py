"""Licenses in a whole table against every place of every template, with a plain quadratic alignment."""

from collections import Counter

import duckdb
import pytest

from hitparade.llm import license_scan
from hitparade.llm.decontamination import WORD, folded
from hitparade.llm.queries import QUERIES
from tests.conftest import SMALL


def rising(pairs):
    """The longest rising subsequence by comparing all pairs; of equally long ones any has the right length."""
    best = []
    for i, (_, y) in enumerate(pairs):
        best.append([*max((best[j] for j in range(i) if pairs[j][1] < y), key=len, default=[]), pairs[i]])
    return max(best, key=len, default=[])


def aligned(a, b):
    """Places of equal words: alike ends, then words unique to both in the longest rising run, then the gaps."""
    if not a or not b:
        return []
    head = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    rest = min(len(a), len(b)) - head
    tail = next((k for k in range(rest) if a[len(a) - 1 - k] != b[len(b) - 1 - k]), rest)
    ends = [(k, k) for k in range(head)] + [(len(a) - 1 - k, len(b) - 1 - k) for k in range(tail)]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    unique = [w for w in x if x.count(w) == 1 and y.count(w) == 1]
    run = rising([(x.index(w), y.index(w)) for w in unique])
    inner, stops = list(run), [(-1, -1), *run, (len(x), len(y))]
    for (i, j), (k, m) in zip(stops, stops[1:]) if run else []:
        inner += [(i + 1 + p, j + 1 + q) for p, q in aligned(x[i + 1 : k], y[j + 1 : m])]
    return sorted(ends + [(head + p, head + q) for p, q in inner])


def expected(text, reserved):
    """(license, first word, last word, aligned words): every place of a signal word, whatever the quick checks say."""
    found = []
    for t in license_scan.templates(reserved):
        n, slack, own = len(t.words), max(3, len(t.words) // 5), []
        if 100 * (Counter(t.words) & Counter(text)).total() < license_scan.COVERAGE * n:
            continue
        for start in sorted({i - k for i, word in enumerate(text) for k in t.signals if word == t.words[k]}):
            if own and start + slack <= own[-1][1]:
                continue
            least = own[-1][1] + 1 if own else 0
            low, high = max(least, start - slack), min(len(text), start + n + slack)
            pairs, before = aligned(list(t.words), text[low:high]), -1
            while len(pairs) > before and pairs:
                kept, before = (low, high, pairs), len(pairs)
                if pairs[-1][0] < n - 1:
                    high = min(len(text), max(high, kept[0] + pairs[-1][1] + 1 + slack))
                if pairs[0][0]:
                    low = max(least, min(low, kept[0] + pairs[0][1] - slack))
                pairs = aligned(list(t.words), text[low:high])
            if before > 0:
                low, high, pairs = kept
            window = text[low:high]
            if 100 * len(pairs) < license_scan.COVERAGE * n or not t.needed <= {t.words[i] for i, _ in pairs}:
                continue
            first, last = pairs[0][1], pairs[-1][1]
            if not any(p in b" %s " % b" ".join(window[first : last + 1]) for p in t.barred):
                own.append((low + first, low + last, len(pairs)))
        found += [(t.name, *m, n) for m in own]
    kept = []
    for m in sorted(found, key=lambda m: (-m[3], -m[3] / m[4], m[0], m[1])):
        if all(m[2] < k[1] or m[1] > k[2] for k in kept):
            kept.append(m)
    return kept


@pytest.mark.parametrize("name, reserved", [("op1_license_scan", False), ("op1_license_scan_all", True)])
def test_whole_table(spark, name, reserved):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    rows = []
    for doc_id, text in texts:
        at = [m.span() for m in WORD.finditer(text or "")]
        rows += [(doc_id, license, at[a][0], at[b][1], matched, n) for license, a, b, matched, n in expected(folded(text), reserved)]
    columns = "doc_id", "license", "start", "end", "n_matched", "n_template"
    assert sorted(map(tuple, QUERIES[name](spark, SMALL).select(*columns).collect())) == sorted(rows) and rows


@pytest.mark.parametrize("name", sorted({t.name for t in license_scan.templates()}))
def test_templates_with_changes(name):
    """Every template with words left out, changed and put in is found as the plain version finds it."""
    for t in (t for t in license_scan.templates() if t.name == name and len(t.words) < 400):
        text = [w for i, w in enumerate(t.words) if i % 11 != 7 or w in t.needed or i in t.signals]
        text = [b"before", b"it", *(x for i, w in enumerate(text) for x in ([w, b"more"] if i % 13 == 5 else [w])), b"after"]
        found = license_scan.found_in(text)
        assert {(m[0], m[3]) for m in found} == {(m[0], m[3]) for m in expected(text, False)}


@pytest.mark.parametrize("every, more", [(1, 1), (3, 2), (2, 3)])
def test_words_put_in_between_lose_no_match(every, more):
    """A match reaches from the first word of a template to the last, however many others stand between them. Of its words
    only some that have no unique one between two anchors are not aligned."""
    for t in (t for t in license_scan.templates() if t.name in ("MIT", "ISC", "BSD-2-Clause", "Apache-2.0")):
        text = [b"head", b"line"]
        for i, word in enumerate(t.words):
            text += [word, *(b"x%d" % (i * more + k) for k in range(more if i % every == 0 else 0))]
        (best, *_) = sorted((m for m in license_scan.found_in([*text, b"tail"]) if m[0] == t.name), key=lambda m: -m[3])
        last = len(text) - 1 - (more if (len(t.words) - 1) % every == 0 else 0)
        assert best[1:3] == (2, last) and best[3] >= 0.95 * len(t.words)
