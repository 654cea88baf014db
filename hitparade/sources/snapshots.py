"""Daily snapshot CSV files, one file per country."""

from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.times import trending_date
from hitparade.schemas import RAW_SNAPSHOT
from hitparade.session import cut_lineage
from hitparade.sources.files import decoded

def country_directories(base: str, countries=fixed.COUNTRIES) -> str:
    """Path pattern for {base}/{country}/{country}videos.csv."""
    return f"{base}/{{{','.join(f'{country}/{country}videos.csv' for country in countries)}}}"


def flat_directory(base: str, countries=fixed.COUNTRIES) -> str:
    """Path pattern for {base}/{country}videos.csv."""
    return f"{base}/{{{','.join(countries)}}}videos.csv"


def read_snapshots(spark: SparkSession, pattern: str, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """All files of the pattern, with the country taken from the file name; absent files are left out.

    Calling this runs the first scan at once: it works out for each file block whether a quoted field with line breaks is
    open where it starts or is opened in it, and stores that by `cut`. Lines of other blocks are records and go straight to
    the parser, without a shuffle at any number of blocks: what is sent to the tasks is the exceptions, a row for each file
    with such blocks (a number for each, of 128 MB as a rule) or with an unusual header, and a row for each such block. Records
    of several lines are put together on the way; only lines of those that go on in another block are shuffled.
    """
    lines = _lines(spark, pattern)
    blocks = cut(_block_states(lines))
    headers = blocks.groupBy("header").agg(F.count_distinct("file").alias("files")).where("header is not null")
    usual = headers.orderBy(F.col("files").desc(), "header").select("header").first()
    usual = usual["header"] if usual else ""
    broken = F.sort_array(F.collect_set(F.when(F.col("broken"), F.col("block")))).alias("broken_blocks")
    files = blocks.groupBy("file").agg(broken, F.first("header").alias("header"))
    exceptions = cut(files.where((F.size("broken_blocks") > 0) | (F.col("header") != usual)))
    marked = lines.join(F.broadcast(exceptions), "file", "left").withColumn("header", F.coalesce("header", F.lit(usual)))
    marked = marked.where((F.col("block") > 0) | (F.col("text") != F.col("header"))).drop("header")
    entangled = F.coalesce(F.array_contains("broken_blocks", F.col("block")), F.lit(False))
    records = marked.where(~entangled & (F.trim("text") != "")).select("file", "text")
    if not exceptions.where(F.size("broken_blocks") > 0).isEmpty():
        states = blocks.where("broken").select("file", "block", "entered", "entered_block", "unclosed_block")
        records = records.union(_records(marked.where(entangled).drop("broken_blocks").join(F.broadcast(states), ["file", "block"])))
    parsed = F.from_csv("text", RAW_SNAPSHOT.simpleString(), {"escape": '"'})
    return records.select(parsed.alias("row"), _country(F.col("file")).alias("country")).select("row.*", "country")


def _country(file: Column) -> Column:
    """What stands before videos.csv in the name of a file, empty for other names."""
    name = F.substring_index(file, "/", -1)
    return F.when(name.endswith("videos.csv"), decoded(F.substring(name, F.lit(1), F.length(name) - len("videos.csv")))).otherwise("")


def _lines(spark, pattern) -> DataFrame:
    """(file, block, line, text): line rises within a block."""
    return spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )


def _block_states(lines: DataFrame) -> DataFrame:
    """One row per file block: is a quoted field open where it starts (entered), and in which block that record started
    (entered_block); is the block broken, that is, touched by a record of several lines; the block in which a record starts
    that its file never closes (unclosed_block); and the header, the first line of its file that is not blank.

    Lines without a quote keep the state, so only of those with one a number each is collected; a block bounds them.
    """
    outside, inside = _ends_inside(F.col("text"))
    lines = lines.withColumns({"outside": outside, "inside": inside})
    # A number that sorts by line. Lines that end as they start, in either case, tell nothing.
    mark = F.shiftleft("line", 2) + 2 * F.col("outside") + F.col("inside")
    telling = (F.col("outside") == 1) | (F.col("inside") == 0)
    first_line = F.min_by("text", F.when(F.trim("text") != "", F.col("line")))
    marks = lines.groupBy("file", "block").agg(F.sort_array(F.collect_list(F.when(telling, mark))).alias("marks"), first_line.alias("first_line"))

    def folded(state):
        """0 or 1 as the block ends outside or inside of a field, and 2 more if a field is opened in it."""
        ends = lambda s, m: F.when(s % 2 == 0, m.bitwiseAND(F.lit(2)) / 2 * 3).otherwise(m.bitwiseAND(F.lit(1)))
        return F.aggregate("marks", F.lit(state), lambda s, m: s.bitwiseAND(F.lit(2)).bitwiseOR(ends(s, m).cast("int")))

    blocks = marks.select("file", "block", "first_line", folded(0).alias("a"), folded(1).alias("b"))
    blocks = blocks.withColumns({"from_outside": F.col("a") % 2, "from_inside": F.col("b") % 2})
    blocks = _with_states(blocks, ["file"], "block").withColumnRenamed("if_outside", "entered")
    taken = F.when(F.col("entered") == 0, F.col("a")).otherwise(F.col("b"))
    opened, left = taken >= 2, taken % 2
    in_file = Window.partitionBy("file").orderBy("block")
    earlier, whole = in_file.rowsBetween(Window.unboundedPreceding, -1), in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    start = F.when(opened, F.col("block"))
    return blocks.select(
        "file",
        "block",
        "entered",
        F.last(start, ignorenulls=True).over(earlier).alias("entered_block"),
        (opened | (F.col("entered") == 1)).alias("broken"),
        F.when(F.last(left).over(whole) == 1, F.last(start, ignorenulls=True).over(whole)).alias("unclosed_block"),
        F.first("first_line", ignorenulls=True).over(whole).alias("header"),
    )


def _ends_inside(text: Column) -> tuple[Column, Column]:
    """Does a line end inside a quoted field, if it starts outside of one, and if it starts inside?

    Doubled quotes go first: they leave either state as it is. A quote that follows a comma, or the line's start, turns either
    state: it opens a field or closes one. Any other quote leaves the line outside of fields: it closes one or is plain text. So
    what counts is whether there are such others, and how many of the first kind follow the last of them. There are no
    conditions, so that each step is taken once for both states.
    """
    quote = F.lit('"')
    whole = F.concat(F.lit(","), F.replace(text, F.lit('""'), F.lit("")))
    others = F.replace(whole, F.lit(',"'), F.lit(",,"))
    after = F.length(F.substring_index(others, '"', -1))
    turns = after - F.length(F.replace(F.right(whole, after), quote, F.lit("")))
    kept = (~F.contains(others, quote)).cast("int")
    return turns % 2, (turns + kept) % 2


def _with_states(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows with the state before them, if their sequence starts outside of a field.

    A row either fixes the state that follows it or keeps or flips it, so that the state is the one last fixed,
    flipped as often as rows since then do.
    """
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = F.when((F.col("from_outside") == 1) & (F.col("from_inside") == 0), 1).otherwise(0)
    fixes = F.col("from_outside") == F.col("from_inside")
    rows = rows.withColumn("flips", F.coalesce(F.sum(flips).over(earlier), F.lit(0)))
    last_fixed = F.last(F.when(fixes, F.col("from_outside") + F.col("flips")), ignorenulls=True).over(earlier)
    return (
        rows.withColumn("fixed", last_fixed)
        .withColumn("if_outside", (F.coalesce("fixed", F.lit(0)) + F.col("flips")) % 2)
        .drop("flips", "fixed")
    )


def _assembler(across: bool):
    """A function over batches of lines of broken blocks, in their order: the records (file, text) that lie in one block, or, across
    blocks, the lines of the others (file, start_block, block, line, text). It is sent to the workers as a whole."""
    names = ["file", "start_block", "block", "line", "text"] if across else ["file", "text"]
    kinds = {"file": pa.string(), "start_block": pa.int64(), "block": pa.int64(), "line": pa.int64(), "text": pa.binary()}
    schema = pa.schema([(name, kinds[name]) for name in names])

    def out(file, texts, places=None):
        n = len(texts)
        columns = {"file": pa.repeat(pa.scalar(file, pa.string()), n), "text": texts.cast(pa.binary())}
        if across:
            columns |= {"start_block": pa.repeat(pa.scalar(places[0], pa.int64()), n), "block": pa.repeat(pa.scalar(places[1], pa.int64()), n), "line": places[2]}
        return pa.record_batch([columns[name] for name in names], schema=schema)

    def goes_on(lines, file, block, start_block, unclosed_block):
        """Lines of a record of several blocks; each is a record where the quote is never closed."""
        if start_block != unclosed_block:
            if across:
                yield out(file, lines.column("text"), (start_block, block, lines.column("line")))
        elif not across:
            yield out(file, lines.column("text").filter(pc.invert(lines.column("blank"))))

    def joined(lines, starts):
        """The records of lines that start at these places."""
        texts = lines.column("text")
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(texts)), pa.int32()), texts), pa.scalar(b"\n", pa.binary()))
        blank = lines.column("blank").to_numpy(zero_copy_only=False)[starts] & (np.diff(starts, append=len(texts)) == 1)
        return whole.filter(pa.array(~blank)) if blank.any() else whole

    def states(lines, state):
        """The states before lines, and the one after the last."""
        outside, inside = (lines.column(c).to_numpy() for c in ("from_outside", "from_inside"))
        flips = np.cumsum((outside == 1) & (inside == 0))
        fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(len(flips)), -1))
        after = np.where(fixed >= 0, outside[fixed] + flips - flips[fixed], state + flips) % 2
        return np.append(state, after[:-1]), int(after[-1])

    def assemble(batches):
        key, opened, state = None, [], 0  # of the block: file, block, entered_block, unclosed_block; its open record; the state
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block = batch.column("file"), batch.column("block").to_numpy()
            new = np.flatnonzero((block[1:] != block[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)) + 1
            for first, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
                lines = batch.slice(first, end - first)
                here = tuple(lines.column(c)[0].as_py() for c in ("file", "block", "entered_block", "unclosed_block"))
                if here != key:
                    for part in opened:
                        yield from goes_on(part, key[0], key[1], key[1], key[3])
                    key, opened, state = here, [], lines.column("entered")[0].as_py()
                before, state = states(lines, state)
                starts = np.flatnonzero(before == 0)
                head = lines.slice(0, int(starts[0]) if len(starts) else len(before))
                if head.num_rows and opened:
                    opened.append(head)
                elif head.num_rows:
                    yield from goes_on(head, key[0], key[1], key[2], key[3])
                if not len(starts):
                    continue
                if opened and not across:
                    whole = pa.concat_arrays([part.column("text") for part in opened])
                    yield out(key[0], pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole), pa.scalar(b"\n", pa.binary())))
                opened, last = [], len(before)
                if state:
                    last, starts = int(starts[-1]), starts[:-1]
                    opened = [lines.slice(last)]
                if len(starts) and not across:
                    done = lines.slice(int(starts[0]), last - int(starts[0]))
                    yield out(key[0], joined(done, starts - starts[0]))
        for part in opened:
            yield from goes_on(part, key[0], key[1], key[1], key[3])

    return assemble


def _records(placed: DataFrame) -> DataFrame:
    """CSV records (file, text) from the lines of broken blocks.

    A line starts a record where it starts outside of quoted fields. Lines of a block stand together and in order in the scan, so
    records within one are put together on the way, without a shuffle. A record that goes on in later blocks is named by the
    block it starts in, and only its lines are shuffled. A quote that is never closed would make one record of the rest of its
    file: there, lines count as records. Texts are bytes on the way, as files may hold others than UTF-8.
    """
    outside, inside = _ends_inside(F.col("text"))
    lines = placed.select(
        "file", "block", "line", F.col("text").cast("binary").alias("text"), (F.trim("text") == "").alias("blank"),
        F.col("entered").cast("int").alias("entered"), "entered_block", "unclosed_block",
        outside.cast("int").alias("from_outside"), inside.cast("int").alias("from_inside"),
    )
    text = F.col("text").cast("string").alias("text")
    within = lines.mapInArrow(_assembler(False), "file string, text binary").select("file", text)
    across = lines.mapInArrow(_assembler(True), "file string, start_block long, block long, line long, text binary")
    across = across.withColumn("text", text).groupBy("file", "start_block").agg(F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("parts"))
    return within.union(across.select("file", F.concat_ws("\n", F.col("parts.text")).alias("text")))


def load_filter(rows: DataFrame) -> DataFrame:
    """Rows with a video id, a title and non-negative views, with the trending date parsed."""
    return rows.withColumn("trending_date_parsed", trending_date(F.col("trending_date"))).filter(
        F.col("video_id").isNotNull() & F.col("title").isNotNull() & (F.col("views") >= 0)
    )


def missing_countries(rows: DataFrame, countries=fixed.COUNTRIES) -> list[str]:
    """Countries without a file behind these rows, from the file list of the scan."""
    paths = [unquote(path) for path in rows.inputFiles()]
    return [country for country in countries if not any(path.endswith(f"/{country}videos.csv") for path in paths)]


def union_sources(*parts: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, parts)
