"""The rule ensemble: statistics by hand, rules against the trees, held-out labels, and odd rows."""

import math
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from hitparade.llm import rule_ensemble
from hitparade.llm.queries import QUERIES
from hitparade.llm.rule_ensemble import STATISTICS, Condition, statistics_of

MEDIUM = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").where(~held_out)
    return rule_ensemble.fit(documents, labels.select("doc_id", F.col("quality").alias("label")))


def test_held_out_labels(spark):
    found = {r["doc_id"]: r for r in QUERIES["op13_rule_ensemble"](spark, MEDIUM).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{MEDIUM}/labels.parquet'").fetchall())
    assert len(found) == 10_000
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    for value in (0, 1):
        own = [found[i]["predicted"] == value for i, quality in labels.items() if quality == value and found[i]["held_out"]]
        assert len(own) > 50 and sum(own) / len(own) > 0.98


def test_sparse_rules_over_statistics(model):
    assert 1 <= len(model.rules) <= 60 and all(weight for _, weight in model.rules)
    assert {c.statistic for rule, _ in model.rules for c in rule} <= set(STATISTICS)
    assert all(len(rule) <= rule_ensemble.DEPTH for rule, _ in model.rules)


def test_score_is_one_native_expression(spark, model):
    """Python measures the texts; rules and score are expressions of the same plan."""
    plan = rule_ensemble.scored(spark.createDataFrame([(1, "a")], "doc_id long, text string"), model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "PythonUDF" not in plan and "Exchange" not in plan and "CASE WHEN" in plan


def test_score_is_the_logistic_sum(spark, model):
    values = {name: 0.3 * n for n, name in enumerate(STATISTICS)}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} double" for n in STATISTICS))
    holds = lambda rule: all((values[c.statistic] > c.threshold) == c.above for c in rule)
    total = model.intercept + sum(w for rule, w in model.rules if holds(rule))
    assert math.isclose(row.select(model.score()).first()[0], 1 / (1 + math.exp(-total)))


def test_rules_are_the_paths_of_the_trees(spark):
    rows = spark.range(200).select((F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    rows = rows.withColumn("label", ((F.col("a") > 4.5) & (F.col("b") <= 2.5)).cast("double"))
    tree = DecisionTreeClassifier(maxDepth=3).fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows))
    rules = rule_ensemble.paths(tree.toDebugString, ("a", "b"))
    assert len(rules) == tree.numNodes - 1
    assert frozenset({Condition("a", True, 4.5), Condition("b", False, 2.5)}) in {frozenset(Condition(c.statistic, c.above, round(c.threshold, 1)) for c in r) for r in rules}


def test_narrowest_conditions_stay():
    c = Condition
    assert rule_ensemble.simplest([c("x", True, 1.0), c("x", True, 2.0), c("x", False, 9.0), c("x", False, 5.0)]) == {c("x", True, 2.0), c("x", False, 5.0)}


def test_statistics():
    text = "The cat, the Cat!\nab1 é |\n\nThe cat, the Cat!"
    found = {name: values.tolist() for name, values in statistics_of(pa.array([None, "", " \n", text, "a a a b"])).items()}
    words = text.split()
    size = len(text.encode())
    assert all(found[name][:2] == [0, 0] for name in STATISTICS)
    assert found["n_words"] == [0, 0, 0, len(words), 4] and found["n_bytes"] == [0, 0, 2, size, 7]
    assert math.isclose(found["word_length"][3], sum(len(w.encode()) for w in words) / len(words))
    assert math.isclose(found["upper"][3], 4 / size) and math.isclose(found["digits"][3], 1 / size)
    assert math.isclose(found["exclaimed"][3], 2 / len(words)) and math.isclose(found["bars"][3], 1 / len(words))
    assert math.isclose(found["distinct"][3], len(set(words)) / len(words)) and found["distinct"][4] == 0.5
    assert found["commonest"][4] == 0.75 and found["runs"][4] == 0.5 and found["runs"][3] == 0
    assert found["lines"] == [0, 0, 2, 4, 1] and found["repeated_lines"][3] == 0.25
    assert math.isclose(found["marked_words"][3], 3 / len(words))


def test_statistics_do_not_depend_on_neighbours():
    texts = ["a a b", None, "x y\nx y", "", "é É 1 #"]
    whole = statistics_of(pa.array(["zzz", *texts])[1:])
    for n, text in enumerate(texts):
        alone = statistics_of(pa.array([text], pa.string()))
        assert all(whole[name][n] == alone[name][0] for name in STATISTICS)


def test_edges(spark, documents, edge_rows, model):
    docs = documents(edge_rows)
    found = rule_ensemble.scored(docs, model)
    assert found.columns == ["doc_id", "score", "predicted"]
    rows = found.collect()
    assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(str(i) for i, _ in edge_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert rule_ensemble.scored(documents([]), model).collect() == []


def test_without_labels_or_with_one_kind(spark, documents):
    docs = documents([(i, f"some text {i}") for i in range(6)])
    labels = lambda *rows: spark.createDataFrame(rows, "doc_id long, label int")
    score = lambda found: {r["score"] for r in rule_ensemble.scored(docs, rule_ensemble.fit(docs, found)).collect()}
    assert score(labels()) == {0.5}
    (only,) = score(labels((1, 1), (2, 1), (3, None), (None, 0), (4, 0), (4, 1), (99, 0)))
    assert math.isclose(only, 0.75)
    assert rule_ensemble.fit(documents([]), labels((1, 1), (2, 0))).rules == []


def test_few_rows_with_both_labels(spark, documents):
    docs = documents([(i, "good plain words here" if i % 2 else "bad$$ bad$$ bad$$ bad$$") for i in range(12)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] * 2, "doc_id long, label int")
    found = {r["doc_id"]: r["predicted"] for r in rule_ensemble.scored(docs, rule_ensemble.fit(docs, labels)).collect()}
    assert found == {i: i % 2 for i in range(12)}
