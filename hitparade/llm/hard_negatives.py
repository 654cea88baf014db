"""Hard negatives: for an anchor and one of its best neighbours of the same label, the rows of other labels that come close.

Scores are inner products of whole-number vectors. Rows are dealt out to shards of bounded size by a hash, a cover tree is
built over each shard, and blocks of anchors are searched in every shard (positives: in the shards of their label). A shard
gives each search its best rows only, and these are ranked together afterwards.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitparade.llm.cover_tree import LONG, CoverTree
from hitparade.llm.stored import stored

#: Rows in a shard, about: as few as still give WIDE shards, but MOST once there are more rows than that.
FEWEST, WIDE, MOST = 4096, 64, 65_536

ROWS = "id long, label long, vector array<long>"
FOUND = "anchor long, ask int, id long, score long"


def whole(vector: Column, scale: float = 256.0) -> Column:
    """Each component times scale, rounded down; beyond 64 bits the nearest such number."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """No component is null, infinite or no number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def cleaned(rows: DataFrame) -> DataFrame:
    """(id, label, vector) without rows that lack a label or a usable vector; rows that are equal in all three are one."""
    kept = rows.where(F.col("label").isNotNull() & usable(F.col("vector").cast("array<double>")))
    kept = kept.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole(F.col("vector")).alias("vector"))
    return kept.distinct()


def _shards(rows: Column) -> Column:
    """How many shards so many rows are dealt out to."""
    return F.greatest(F.least(F.ceil(rows / FEWEST), F.lit(WIDE)), _blocks(rows)).cast("int")


def _blocks(anchors: Column) -> Column:
    """How many blocks so many anchors are searched in; each block meets every shard."""
    return F.greatest(F.ceil(anchors / MOST), F.lit(1)).cast("int")


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of numbers; shorter vectors go on with zeros."""
    lists = vectors.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(lists)), sizes), place] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers with the smallest one for null."""
    return pc.fill_null(column, LONG.min).to_numpy().astype(np.int64)


def _searched(k: int, other_labels: bool):
    def searched(rows: pa.Table, asks: pa.Table) -> pa.Table:
        names = {"anchor": pa.int64(), "ask": pa.int32(), "id": pa.int64(), "score": pa.int64()}
        if not rows.num_rows or not asks.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in names.items()})
        width = max(pc.max(pc.list_value_length(t.column("vector"))).as_py() or 0 for t in (rows, asks))
        points, queries = _matrix(rows.column("vector"), width), _matrix(asks.column("vector"), width)
        ids, labels = _numbers(rows.column("id")), _numbers(rows.column("label"))
        tree = CoverTree(points, ids)
        # An anchor's own row, if it is here.
        own = np.full(len(queries), -1, np.int64)
        at: dict[tuple, int] = {(i, label, p.tobytes()): n for n, (i, label, p) in enumerate(zip(ids.tolist(), labels.tolist(), points))}
        ask_ids, ask_labels = _numbers(asks.column("id")), _numbers(asks.column("label"))
        for n, key in enumerate(zip(ask_ids.tolist(), ask_labels.tolist(), queries)):
            own[n] = at.get((key[0], key[1], key[2].tobytes()), -1)
        windows = asks.column("windows").combine_chunks()
        sizes = pc.list_value_length(windows).to_numpy(zero_copy_only=False).astype(np.int64)
        each = np.repeat(np.arange(len(queries)), sizes)
        number, low, high = (windows.flatten().field(name).to_numpy(zero_copy_only=False) for name in ("ask", "low", "high"))
        groups = (labels, ask_labels[each]) if other_labels else (None, None)
        search, place, score = tree.search(queries[each], low, high, k, own[each], *groups)
        anchors = asks.column("anchor").to_numpy()
        found = ids[place]
        columns = [pa.array(anchors[each[search]]), pa.array(number[search].astype(np.int32)), pa.array(found, mask=found == LONG.min), pa.array(score)]
        return pa.table(columns, schema=pa.schema(names.items()))

    return searched


def _best(rows: DataFrame, asks: DataFrame, keys: list[str], k: int, other_labels: bool) -> DataFrame:
    """The k best rows of each ask. rows and asks have the keys, and the numbers of shards and blocks."""
    salt = lambda n: F.pmod(F.xxhash64("id", "label", "vector"), F.col(n)).cast("int")
    dealt = rows.withColumn("shard", salt("shards")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = asks.withColumn("block", salt("blocks")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    by = [*keys, "shard", "block"]
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # Shards are small for the work that they make, so they are not put together.
    dealt, asked = (x.drop("shards", "blocks").repartition(parts, *by) for x in (dealt, asked))
    own = dealt.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(_searched(k, other_labels), FOUND)
    order = Window.partitionBy("anchor", "ask").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
    return own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90
) -> DataFrame:
    """Rows of (id, label, vector): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchors says which rows are anchors. An anchor's positives are its best other rows of the same label. Its negatives for
    a positive of score p are the best rows of other labels with a score from low_percent to high_percent of p, so there are
    none where p is negative. Ties go to the smaller id, and no id counts as the smallest. Rows that take part are those of
    cleaned(): rows that repeat in all are one row, and rows that share an id only are rows of their own. Vectors of different
    lengths go on with zeros. An anchor alone in its label has no positives and gives no rows.
    """
    rows = stored(cleaned(rows), "vectors")
    asked = stored(rows.where(anchors).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    one = lambda ask, low, high: F.struct(ask.cast("int").alias("ask"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    shards = rows.groupBy("label").agg(_shards(F.count("*")).alias("shards"))
    blocks = asked.groupBy("label").agg(_blocks(F.count("*")).alias("blocks"))
    shards = stored(shards.join(blocks, "label"), "shards")
    everywhere = asked.withColumn("windows", F.array(one(F.lit(0), F.lit(LONG.min), F.lit(LONG.max))))
    same = _best(rows.join(shards, "label"), everywhere.join(shards, "label"), ["label"], positives, False)
    same = stored(same.drop("ask"), "positives")

    score = F.col("score").cast("decimal(38,0)")
    least, most = F.ceil(score * low_percent / 100), F.floor(score * high_percent / 100)
    windows = same.where(least <= most).groupBy("anchor").agg(F.array_sort(F.collect_list(one(F.col("rank"), least, most))).alias("windows"))
    sizes = {"shards": _shards(F.lit(rows.count())), "blocks": _blocks(F.lit(asked.count()))}
    other = _best(rows.withColumns(sizes), asked.join(windows, "anchor").withColumns(sizes), [], negatives, True)

    pairs = same.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    pairs = pairs.select("anchor", "anchor_id", F.col("rank").alias("ask"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(other, ["anchor", "ask"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
