"""Merkle manifest of a table: what each row's content adds up to, with a proof for every row.

H is the lowercase hex of sha256. A row's leaf is H of its fields; in every group the leaves stand in order, and every FAN
consecutive nodes become the H of their joined digests until one is left, the group's root. The roots of the groups, in
order, become the root of the table in the same way.

A block of FAN ** LEVELS aligned leaves keeps each of its levels as one string of digests of fixed width. Substrings of that
width times FAN are hashed to the next level, and the substrings on either side of a node are its siblings. The roots of
the blocks are the leaves of the next table of blocks, and so on until each group fits into one block. Rows are ranked by
ranges, so no group, however large, meets in one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitparade.llm.stored import stored

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
#: Characters of a digest.
WIDTH = 64
NULL = "-"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value with the number of its bytes, or the mark of a null; no two lists of values give the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(NULL))


def leaf(columns) -> Column:
    return F.sha2(F.concat(*(field(column) for column in columns)), 256)


def group_key(value: Column) -> Column:
    """Text without nulls in the order of the groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(NULL))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings add up to."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof(path: Column) -> Column:
    """H of all siblings, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows (key, ...) with n, the rows of the key, and pos, the place among them.

    Rows are dealt out by ranges of key and order and numbered where they are; only the counts of (range, key) are summed
    up, and they are as many as ranges and keys.
    """
    by = [F.col("key"), *order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("part", F.shiftright("row", 33)), "merkle-ranges")
    counts = ranged.groupBy("key", "part").agg(F.min("row").alias("first"), F.count("*").alias("m"))
    whole = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first")
    counts = stored(counts.select("key", "part", base.alias("base"), F.sum("m").over(whole).alias("n")), "merkle-counts")
    return ranged.join(counts, ["key", "part"]).withColumn("pos", F.col("row") + F.col("base")).drop("row", "base", "part")


def _parents(level: Column) -> Column:
    """The next level: H of every FAN digests of the string."""
    runs = F.ceil(F.length(level) / (FAN * WIDTH)).cast("int")
    at = lambda i: F.substring(level, i * (FAN * WIDTH) + 1, F.lit(FAN * WIDTH))
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(at(i), 256)), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """nodes (key, n, pos, node, more) as blocks with the members, the level strings and the node on top.

    A block collects at most BLOCK nodes. Only the last block of a key has fewer; levels end where the key has one node left.
    """
    member = F.struct("pos", "node", "more")
    own = nodes.groupBy("key", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(member)).alias("members"))
    steps = sum((F.when(F.col("n") > FAN**k, 1).otherwise(0) for k in range(LEVELS)), F.lit(0))
    blocks = own.select("key", "block", "n", "members", steps.alias("steps"), F.array_join(F.col("members.node"), "").alias("level0"))
    for k in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"level{k}", F.when(F.col("steps") >= k, _parents(F.col(f"level{k - 1}"))))
    top = F.coalesce(*(F.col(f"level{k}") for k in reversed(range(LEVELS + 1))))
    return blocks.withColumn("top", top).drop(f"level{LEVELS}")


def _siblings(i: Column, k: int) -> Column:
    """The digests on either side of the node above member i in level k, within its run of FAN."""
    at = F.floor(i / FAN**k).cast("int")
    inside, level = at % FAN, F.col(f"level{k}")
    left = F.substring(level, (at - inside) * WIDTH + 1, inside * WIDTH)
    right = F.substring(level, (at + 1) * WIDTH + 1, (FAN - 1 - inside) * WIDTH)
    return F.struct(left.alias("left"), right.alias("right"))


def _rooted(nodes: DataFrame) -> DataFrame:
    """The blocks of nodes with the path from the block's top up, and the root of the key."""
    blocks = stored(_blocks(nodes), "merkle-blocks")
    largest = blocks.agg(F.max("n")).first()[0] or 0
    if largest <= BLOCK:
        return blocks.withColumn("path", F.array().cast(PATH)).withColumn("root", F.col("top"))
    above = blocks.select(
        "key", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("node"), F.lit(None).cast("string").alias("more")
    )
    above = _members(_rooted(above)).select("key", F.col("pos").alias("block"), "path", "root")
    return blocks.join(above, ["key", "block"])


def _members(blocks: DataFrame) -> DataFrame:
    """One row for each member of the blocks: key, pos, node, more, path and root."""

    def own(m: Column) -> Column:
        i = (m["pos"] - F.col("block") * BLOCK).cast("int")
        levels = (F.when(F.col("steps") > k, F.array(_siblings(i, k))).otherwise(F.array().cast(PATH)) for k in range(LEVELS))
        return F.concat(*levels, F.col("path"))

    rows = F.transform("members", lambda m: F.struct(m["pos"].alias("pos"), m["node"].alias("node"), m["more"].alias("more"), own(m).alias("path")))
    return blocks.select("key", "root", F.explode(rows).alias("m")).select("key", "m.*", "root")


def manifest(documents: DataFrame, columns=COLUMNS, group: str = "lang", order: str = "doc_id", more: Column | None = None) -> DataFrame:
    """One row for each row of documents: order, group, leaf, path, subroot (of its group), root (of the table), and more.

    path has the siblings (left, right) of each level, from the leaf to the root. more is a text or null that goes with the
    row. In a group, rows stand by `order` (null first), then by leaf, so rows that repeat have leaves of their own, and
    other columns play no part. A table without rows gives none. Only digests are shuffled, no text.
    """
    leaves = documents.select(
        group_key(F.col(group)).alias("key"),
        F.col(order).alias("by"),
        leaf(F.col(c) for c in columns).alias("node"),
        (F.lit(None) if more is None else more).cast("string").alias("extra"),
    )
    order_by = [F.col("by").asc_nulls_first(), F.col("node"), F.col("extra")]
    nodes = _numbered(stored(leaves, "merkle-leaves"), order_by)
    blocks = _rooted(nodes.select("key", "n", "pos", "node", F.struct("by", "extra").alias("more")))
    roots = blocks.where("block = 0").select(F.lit("").alias("key"), "root", F.col("key").alias("more"))
    tops = _numbered(roots.select("key", "more", F.col("root").alias("node")), [F.col("more")])
    tops = _members(_rooted(tops.select("key", "n", "pos", "node", "more")))
    tops = tops.select(F.col("more").alias("key"), F.col("path").alias("above"), F.col("root").alias("top_root"))
    whole = blocks.join(tops, "key").withColumns({"path": F.concat("path", "above"), "root": F.struct("root", "top_root")})
    rows = _members(whole)
    return rows.select(
        F.col("more.by").alias(order),
        F.when(F.col("key") != NULL, F.expr("substring(key, 2)")).alias(group),
        F.col("node").alias("leaf"),
        "path",
        F.col("root.root").alias("subroot"),
        F.col("root.top_root").alias("root"),
        F.col("more.extra").alias("more"),
    )


def changed(documents: DataFrame, kept: DataFrame, columns=COLUMNS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """Rows of documents that a stored manifest doesn't vouch for: order, group and leaf of those whose leaf it lacks, or has
    fewer times, or whose siblings there don't lead to its root."""
    now = documents.select(F.col(order), F.col(group).cast("string").alias(group), leaf(F.col(c) for c in columns).alias("leaf"))
    good = kept.where(folded(F.col("leaf"), F.col("path")) == F.col("root")).select(F.col(order), F.col(group), "leaf")
    return now.exceptAll(good)
