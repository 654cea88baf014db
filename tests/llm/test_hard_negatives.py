"""Hard negatives and their search tree against all pairs."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from check import compare
from hitparade.llm import hard_negatives
from hitparade.llm.cover_tree import CoverTree, products
from hitparade.llm.oracle import ORACLE
from hitparade.llm.queries import QUERIES
from tests.conftest import SMALL

LEAST = -(1 << 63)
CLASHING = "id long, label long, vector array<double>, anchor string, score string, rank int, shard string, block string, windows int"


def brute(rows, anchor=lambda i: i is not None and i % 100 == 0):
    """(anchor, positive, rank, negative, scores) over all pairs; rows are (id, label, vector)."""
    kept = {(i, label, tuple(int(np.floor(256 * x)) for x in v)) for i, label, v in rows if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    order = lambda r: (-r[0], LEAST if r[1] is None else r[1])
    out = []
    for one in (r for r in kept if anchor(r[0])):
        scored = [(sum(a * b for a, b in zip(one[2], r[2])), r[0], r[1] == one[1]) for r in kept if r != one]
        for p, positive, _ in sorted((s for s in scored if s[2]), key=order)[:5]:
            inside = sorted((s for s in scored if not s[2] and 30 * p <= 100 * s[0] <= 90 * p), key=order)[:10]
            out += [(one[0], positive, n + 1, negative, p, score) for n, (score, negative, _) in enumerate(inside)]
    return sorted(out, key=str)


def mined(spark, rows):
    full = [(*r, "a", "b", 1, "c", "d", 2) for r in rows]
    found = hard_negatives.mined(spark.createDataFrame(full, CLASHING), F.col("id") % 100 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_sql(spark):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    name = "op12_hard_negatives"
    assert compare(QUERIES[name](spark, SMALL), connection.sql(ORACLE[name])).startswith("ok")


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END, embedding FROM '{SMALL}/embeddings.parquet'").fetchall()
    found = QUERIES["op12_hard_negatives"](spark, SMALL).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows) and found


@pytest.mark.parametrize("shard", [7, 4096])
def test_edges(spark, monkeypatch, shard):
    """Nulls, odd numbers, ties, rows that repeat, one hot vector, a lone label, vectors of other lengths, several blocks."""
    monkeypatch.setattr(hard_negatives, "FEWEST", shard)
    monkeypatch.setattr(hard_negatives, "MOST", 8 * shard)
    rng = np.random.default_rng(5)
    rows = [(25 * i, int(rng.integers(3)), [round(float(x), 2) for x in rng.normal(size=4)]) for i in range(120)]
    rows += [(10_000 + i, i % 3, [0.5, 0.25, 0.125, 0.5]) for i in range(60)]
    rows += [(100, 0, [1.0, 1.0, 1.0, 1.0]), (100, 0, [1.0, 1.0, 1.0, 1.0]), (100, 1, [1.0, 1.0, 1.0, 1.0]), (100, 0, [1.0, 1.0])]
    rows += [(None, 1, [0.75, 0.75, 0.75, 0.75]), (None, None, [1.0]), (900, 7, [1.0, 0.0, 0.0, 0.0]), (1000, 2, []), (1100, 1, None)]
    rows += [(1200, 1, [None, 1.0]), (1300, 1, [float("nan")] * 4), (1400, 1, [float("inf")] * 4), (1500, 2, [0.0] * 4)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, rows[:1]) == []


def test_numbers_beyond_64_bits(spark):
    rows = [(0, 1, [1e15, 3.0]), (1, 1, [1e15, 1.0]), (2, 1, [9e14, 7.0]), (3, 2, [3e14, 5.0]), (4, 2, [1.0, 1.0]), (100, 2, [1e300, 1.0])]
    found = mined(spark, rows)
    assert {r[0] for r in found} <= {0, 100} and all(-(1 << 63) <= x < 1 << 63 for r in found for x in r[4:])
    exact = products(np.array([[3 << 30, 1]]), np.array([[1 << 28, 7], [-(1 << 40), 0]]))
    assert exact.tolist() == [[(3 << 58) + 7, LEAST]]


def searched(points, ids, queries, low, high, k, groups=None, query_groups=None):
    tree = CoverTree(points, ids)
    number, place, score = tree.search(queries, low, high, k, np.full(len(queries), -1), groups, query_groups)
    return sorted(zip(number.tolist(), ids[place].tolist(), score.tolist()))


def plain(points, ids, queries, low, high, k, groups=None, query_groups=None):
    out = []
    for n, scores in enumerate(queries @ points.T):
        ok = [(-s, i) for j, (s, i) in enumerate(zip(scores.tolist(), ids.tolist())) if low[n] <= s <= high[n] and (groups is None or groups[j] != query_groups[n])]
        out += [(n, i, -s) for s, i in sorted(ok)[:k]]
    return sorted(out)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 5), st.integers(1, 60), st.integers(0, 1 << 30), st.booleans())
def test_tree(n, width, spread, seed, grouped):
    rng = np.random.default_rng(seed)
    middles = rng.integers(-300, 300, (8, width))
    points = middles[rng.integers(8, size=n)] + rng.integers(-spread, spread, (n, width))
    points[rng.random(n) < 0.2] = points[0]
    queries = rng.integers(-300, 300, (20, width))
    low = rng.integers(-90_000, 90_000, 20)
    rest = (low, low + rng.integers(0, 60_000, 20), 4)
    groups = (rng.integers(3, size=n), rng.integers(3, size=20)) if grouped else ()
    ids = rng.permutation(n)
    assert searched(points, ids, queries, *rest, *groups) == plain(points, ids, queries, *rest, *groups)


def test_tree_covers_and_skips():
    """Every point is within the radius of the nodes above it, and clusters out of a window are never opened."""
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(40, 32)) * 400
    points = np.floor(np.repeat(middles, 100, axis=0) + rng.normal(size=(4000, 32)) * 3).astype(np.int64)
    tree = CoverTree(points, np.arange(4000))
    assert len(tree.ends) > 40 and all((radii >= 0).all() for radii in tree.radii)
    queries = np.floor(middles[:5]).astype(np.int64)
    best = (queries @ points.T).max(axis=1)
    upper = tree._leaf_bounds(queries.astype(float), best * 0.95, best.astype(float))
    assert np.isfinite(upper).mean() < 0.2
    scores = queries @ tree.points.T
    for leaf in range(len(tree.ends) - 1):
        inside = scores[:, tree.ends[leaf] : tree.ends[leaf + 1]]
        wide = tree._leaf_bounds(queries.astype(float), np.full(5, -1e18), np.full(5, 1e18))
        assert (inside.max(axis=1) <= wide[:, leaf]).all()
