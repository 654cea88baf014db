"""Quality classifier: a sparse ensemble of rules over statistics of texts.

A forest is fitted on a bounded sample of labelled texts. Every path from a root to a node is a rule, a conjunction of
comparisons. A lasso logistic fit over the rules keeps few of them, and these, with their weights, become one Spark column
expression over the statistics.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitparade.llm import words
from hitparade.llm.stored import stored

#: Labelled documents that the rules are fitted on, at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 24, 3, 42
#: Strength of the lasso.
PENALTY = 0.0005

STATISTICS = (
    "n_words", "n_bytes", "word_length", "letters", "upper", "digits", "symbols", "bars", "exclaimed", "stops",
    "distinct", "commonest", "lines", "repeated_lines", "marked_words", "runs",
)


def _kinds() -> np.ndarray:
    """For each byte, the bits of the classes it is in."""
    table = np.zeros(256, np.uint8)
    for bit, members in enumerate(
        (
            [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)],
            range(0x41, 0x5B),
            range(0x30, 0x3A),
            b"#*$%&<>@^_=~{}[]\\/+",
            b"|",
            b"!?",
            b".,;:",
            b"\n",
        )
    ):
        table[list(members)] |= 1 << bit
    return table


KINDS = _kinds()
MARKED = "[#*$%&|<>!?]$"


def _texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, without nulls, and their offsets."""
    _, bounds, data = texts.buffers()
    offsets = np.frombuffer(bounds, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][offsets])


def _distinct(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct codes each text has, and how often the commonest occurs."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    begins = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])]) if len(codes) else np.empty(0, np.int64)
    sizes, most = np.diff(np.r_[begins, len(codes)]), np.zeros(n, np.int64)
    np.maximum.at(most, owner[begins], sizes)
    return np.bincount(owner[begins], minlength=n), most


def statistics_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text; a null or empty text has 0 throughout."""
    texts = pc.fill_null(texts, "")
    raw, offsets = _texts(texts)
    kinds = KINDS[raw]
    count = lambda bit: _sums((kinds >> bit) & 1, offsets)
    size = np.diff(offsets)
    codes, ends, vocabulary = words.split(texts)
    n = np.diff(ends)
    share = lambda x, of: np.divide(x, of, out=np.zeros(len(size)), where=of > 0)
    marked = pc.match_substring_regex(vocabulary, MARKED).to_numpy(zero_copy_only=False)
    distinct, commonest = _distinct(codes, ends)
    same = np.r_[False, codes[1:] == codes[:-1]] if len(codes) else np.empty(0, bool)
    same[ends[:-1][n > 0]] = False
    lines = pc.split_pattern(texts, "\n")
    coded = pc.utf8_trim_whitespace(lines.values).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = lines.offsets.to_numpy().astype(np.int64)
    line_codes, bounds = coded[bounds[0] : bounds[-1]], bounds - bounds[0]
    n_lines = np.diff(bounds)
    n_symbols, n_bars, n_marks, n_stops = count(3), count(4), count(5), count(6)
    columns = (
        n, size, share(size - _spaces(raw, offsets), n), share(count(0), size), share(count(1), size), share(count(2), size),
        share(n_symbols, n), share(n_bars, n), share(n_marks, n), share(n_stops, n), share(distinct, n), share(commonest, n),
        np.where(size > 0, n_lines, 0), share(n_lines - _distinct(line_codes, bounds)[0], n_lines),
        share(_sums(marked[codes], ends), n), share(_sums(same, ends), n),
    )
    return {name: np.asarray(column, np.float64) for name, column in zip(STATISTICS, columns)}


def _spaces(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return _sums((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)), offsets)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.slices(batches):
        found = statistics_of(batch.column("text"))
        yield pa.record_batch([batch.column("row"), *map(pa.array, found.values())], ["row", *found])


def statistics(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep in the struct row, beside the statistics of the texts. Nothing else is read, and nothing shuffled."""
    rows = documents.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
    schema = rows.select("row").schema
    for name in STATISTICS:
        schema = schema.add(name, "double")
    return rows.mapInArrow(_measured, schema)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


Rule = frozenset[Condition]


def column_of(rule: Rule) -> Column:
    """1 where all conditions of the rule hold."""
    return F.when(reduce(and_, (c.column() for c in sorted(rule, key=str))), 1.0).otherwise(0.0)


def simplest(conditions: list[Condition]) -> Rule:
    """Of the conditions on one side of a statistic only the narrowest."""
    kept: dict[tuple[str, bool], Condition] = {}
    for c in conditions:
        other = kept.get((c.statistic, c.above))
        if other is None or (c.threshold > other.threshold) == c.above:
            kept[c.statistic, c.above] = c
    return frozenset(kept.values())


SPLIT = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def paths(tree: str, names=STATISTICS) -> list[Rule]:
    """The rules of a tree from its description: the path to every node but the root."""
    found, open_ = [], []
    for line in tree.splitlines():
        if match := SPLIT.match(line):
            depth, feature = len(match[1]), names[int(match[3])]
            open_ = [(d, c) for d, c in open_ if d < depth]
            open_.append((depth, Condition(feature, match[4] == ">", float(match[5]))))
            found.append(simplest([c for _, c in open_]))
    return found


@dataclass
class RuleModel:
    """Weighted rules; the score is the logistic function of their sum."""

    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        """The score as one expression over the statistics."""
        total = reduce(add, (column_of(rule) * weight for rule, weight in self.rules), F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id and label (0 or 1): of the ids whose rows agree on one, those with the smallest hashes, at most so many."""
    agreed = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    agreed = agreed.where("label = most").drop("most")
    return agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, penalty: float = PENALTY) -> RuleModel:
    """Rules fitted on the documents of at most `rows` labels (doc_id, label 0 or 1), either label with the same weight in the
    forest and its own in the final fit.

    Which labels are used does not depend on how the rows are dealt out; the fit reads one sorted partition, which rows
    bounds (a document that repeats an id counts once). Without labels the score is 0.5, with labels of one kind the
    share of ones, 1 counted on either side.
    """
    chosen = stored(sample(labels, rows), "labels")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("one")).select("doc_id", "one.*")
    known = statistics(known, ["doc_id", "label"]).select("row.doc_id", F.col("row.label").cast("double").alias("label"), *STATISTICS)
    known = stored(known.repartition(1).sortWithinPartitions("doc_id"), "statistics")
    good, total = known.agg(F.sum("label"), F.count("*")).first()
    good = good or 0.0
    if good in (0, total):
        return RuleModel([], float(np.log((good + 1) / (total - good + 1))))
    weight = F.when(F.col("label") == 1, total / 2 / good).otherwise(total / 2 / (total - good))
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(known.withColumn("weight", weight))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", featureSubsetStrategy="onethird")
    found = {rule for tree in forest.fit(assembled).trees for rule in paths(tree.toDebugString)}
    rules = sorted(found, key=lambda r: sorted(map(str, r)))
    names = [f"rule{i}" for i in range(len(rules))]
    # Rows for which the same rules hold are one row with their number as its weight.
    held = known.select("label", *(column_of(rule).alias(name) for rule, name in zip(rules, names)))
    held = VectorAssembler(inputCols=names, outputCol="features").transform(held).groupBy("label", "features").agg(F.count("*").cast("double").alias("weight"))
    held = stored(held.coalesce(1).sortWithinPartitions("label", F.col("features").cast("string")), "rule-rows")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False, weightCol="weight", maxIter=60).fit(held)
    weights = lasso.coefficients.toArray()
    return RuleModel([(rule, float(w)) for rule, w in zip(rules, weights) if w], float(lasso.intercept))


def scored(documents: DataFrame, model: RuleModel, least: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 where the score is at least `least`) of every row of documents."""
    rows = statistics(documents, ["doc_id"]).select("row.doc_id", model.score().alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= least, 1).otherwise(0))
