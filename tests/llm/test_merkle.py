"""The Merkle manifest against a plain recursion over Python lists."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from check import compare
from hitparade.llm import merkle
from hitparade.llm.oracle import ORACLE
from hitparade.llm.queries import QUERIES
from tests.conftest import SMALL

LOWER = {c: c + 32 for c in range(65, 91)}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root and, for each node, its siblings level by level as (left, right)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for path, i in zip(paths, at):
            path.append(("".join(runs[i // 8][: i % 8]), "".join(runs[i // 8][i % 8 + 1 :])))
        level, at = [digest(*run) for run in runs], [i // 8 for i in at]
    return level[0], paths


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, text, lang, source, n_chars)."""
    groups, out = defaultdict(list), []
    for doc_id, text, lang, source, n_chars in rows:
        values = [doc_id, source, lang, n_chars, text]
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        other = leaf_of([*values[:4], text and text.translate(LOWER)]) if tampered else None
        groups[lang].append((doc_id is not None, doc_id or 0, leaf_of(values), other))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([r[2] for r in sorted(groups[lang], key=lambda r: r[:3])]) for lang in langs}
    root, above = tree([trees[lang][0] for lang in langs]) if langs else ("", [])
    for lang, top in zip(langs, above):
        for (there, doc_id, leaf, other), path in zip(sorted(groups[lang], key=lambda r: r[:3]), trees[lang][1]):
            node = other or leaf
            for left, right in [*path, *top]:
                node = digest(left, node, right)
            proof = digest(*(s for pair in [*path, *top] for s in pair))
            out.append((doc_id if there else None, leaf, trees[lang][0], root, proof, node, node == root))
    return sorted(out, key=str)


NAMES = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"


def found(spark, monkeypatch, rows, columns="doc_id long, text string, lang string, source string, n_chars long"):
    from hitparade.llm import queries

    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, columns))
    return sorted((tuple(r[n] for n in NAMES) for r in QUERIES["op11_merkle_manifest"](spark, "").collect()), key=str)


def test_whole_table(spark):
    documents = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SMALL}/documents.parquet'").fetchall()
    got = sorted((tuple(r[n] for n in NAMES) for r in QUERIES["op11_merkle_manifest"](spark, SMALL).collect()), key=str)
    assert got == expected(documents) and {r[-1] for r in got} == {True, False}


def test_sql(spark):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    name = "op11_merkle_manifest"
    assert compare(QUERIES[name](spark, SMALL), connection.sql(ORACLE[name])).startswith("ok")


@pytest.mark.parametrize("levels", [1, 3])
def test_blocks_of_any_height(spark, monkeypatch, levels):
    """Groups that fill blocks exactly, with one more, and of one row; small blocks make the roots recurse."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8**levels)
    sizes = {"a": 1, "b": 2, "c": 8, "d": 9, "e": 64, "f": 65, "g": 513, None: 7, "": 3, "é": 1}
    rows = [(1000 * n + i, f"Text {i}", lang, "s", i) for n, (lang, size) in enumerate(sizes.items()) for i in range(size)]
    assert found(spark, monkeypatch, rows) == expected(rows)


def test_edges(spark, monkeypatch, edge_rows):
    rows = [(i, t, lang, None if n % 4 == 0 else "s:-", n or None) for n, (i, t) in enumerate(edge_rows) for lang in ("en", None)]
    rows += rows[:5]
    got = found(spark, monkeypatch, rows)
    assert got == expected(rows)
    assert found(spark, monkeypatch, []) == []
    assert found(spark, monkeypatch, rows[:1]) == expected(rows[:1])
    clashing = "doc_id long, text string, lang string, source string, n_chars long, key string, pos int, path string, root int, more int"
    assert found(spark, monkeypatch, [(*r, "k", 1, "p", 2, 3) for r in rows], clashing) == got


def test_fields_are_told_apart(spark):
    rows = spark.createDataFrame([("1", None), (None, "1"), ("1-", ""), ("", "1-"), ("-", None), (None, None)], "a string, b string")
    assert rows.select(merkle.leaf([F.col("a"), F.col("b")])).distinct().count() == 6


def test_changed_rows_are_found(spark, documents):
    before = documents([(i, f"text {i}") for i in range(100)])
    kept = merkle.manifest(before)
    after = before.withColumn("text", F.when(F.col("doc_id") == 42, "other").otherwise(F.col("text")))
    assert merkle.changed(before, kept).count() == 0
    assert [r.doc_id for r in merkle.changed(after, kept).collect()] == [42]


def test_hot_group_meets_in_no_task(spark, monkeypatch):
    """Ranks come from ranges and small counts: no window runs over the rows of a group."""
    plans = []
    monkeypatch.setattr(merkle, "stored", lambda df, name, kept=merkle.stored: plans.append(df._jdf.queryExecution().toString()) or kept(df, name))
    merkle.manifest(spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long"))
    assert all("Window" not in plan for plan in plans if "rangepartitioning" in plan and "partial_" not in plan)
    assert not any("RangePartitioning" in plan and "text" in plan.split("Physical Plan")[-1] for plan in plans)
