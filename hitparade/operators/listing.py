"""Filtered and ranked listings of the stored top videos."""

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.functions.numbers import clamp, compact, engagement_or_zero, one_decimal, percent, zero_if_null
from hitparade.functions.texts import or_default, watch_link
from hitparade.operators.lookups import with_category_name
from hitparade.schemas import TOP_VIDEO
from hitparade.sources.results import on_date, with_document_date

SORT_COLUMNS = {"views": "views", "likes": "likes", "comments": "comment_count", "engagement": "engagement"}
KEY_COLUMNS = ("video_id", "country", "date")


def row_engagement() -> Column:
    return engagement_or_zero(F.col("likes"), F.col("comment_count"), F.col("views"))


def listing_rows(
    documents: DataFrame, country: str | None = None, category: str | int | None = None, date: str | None = None
) -> DataFrame:
    """One row per listed video; documents without videos give none."""
    if country:
        documents = documents.filter(F.col("country") == country)
    if date and date.strip():
        documents = on_date(documents, date)
    rows = with_document_date(documents).select(F.inline("top_videos"), "country", "date", "processed_at")
    if category not in (None, ""):
        rows = rows.filter(F.col("category_id") == int(category))
    return rows


def sort_order(sort_by: str | None = "views", order: str | None = "desc") -> list[Column]:
    """Sort columns of a listing: an unknown key means views, anything but `asc` means descending."""
    key = SORT_COLUMNS.get((sort_by or "views").lower(), "views")
    ascending = (order or "desc").lower() == "asc"
    first = F.col(key).asc_nulls_first() if ascending else F.col(key).desc_nulls_last()
    ties = [*KEY_COLUMNS, *[name for name in TOP_VIDEO.names if name not in KEY_COLUMNS]]
    return [first, *[F.col(name).asc_nulls_first() for name in ties if name != key]]


def sortable(rows: DataFrame, sort_by: str | None) -> DataFrame:
    if (sort_by or "views").lower() == "engagement" and "engagement" not in rows.columns:
        return rows.withColumn("engagement", row_engagement())
    return rows


def listing(
    documents: DataFrame,
    country: str | None = None,
    category: str | int | None = None,
    date: str | None = None,
    sort_by: str | None = "views",
    order: str | None = "desc",
    limit: int = fixed.LISTING_LIMIT,
) -> DataFrame:
    """The first rows of the filtered and sorted listing."""
    if not 1 <= limit <= fixed.LISTING_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {fixed.LISTING_LIMIT_MAX}")
    rows = sortable(listing_rows(documents, country, category, date), sort_by)
    return rows.orderBy(*sort_order(sort_by, order)).limit(limit)


def page(rows: DataFrame, number: int, sort_by="views", order="desc", size: int = fixed.PAGE_SIZE) -> DataFrame:
    """One page of a listing, counted from 1."""
    if number < 1:
        raise ValueError("pages count from 1")
    return sortable(rows, sort_by).orderBy(*sort_order(sort_by, order)).offset((number - 1) * size).limit(size)


def _key_columns(sort_by: str | None, order: str | None) -> list[tuple[str, bool]]:
    """The columns of sort_order with their direction: is it the ascending one, with nulls first?"""
    key = SORT_COLUMNS.get((sort_by or "views").lower(), "views")
    ties = [*KEY_COLUMNS, *[name for name in TOP_VIDEO.names if name not in KEY_COLUMNS]]
    return [(key, (order or "desc").lower() == "asc"), *[(name, True) for name in ties if name != key]]


def page_key(row: Mapping, sort_by="views", order="desc") -> dict:
    """What a page has to know of the last row before it."""
    return {name: row[name] for name, _ in _key_columns(sort_by, order)}


def page_after(rows: DataFrame, key: Mapping | None = None, sort_by="views", order="desc", size: int = fixed.PAGE_SIZE) -> DataFrame:
    """The page that follows the row with this key, or the first page; of deep pages, too, no task holds more than size rows.

    The comparison with the key's first column stands by itself, so that it reaches the files of a stored listing.
    """
    rows = sortable(rows, sort_by)
    if key is not None:
        comes_after, same = [], F.lit(True)
        for name, ascending in _key_columns(sort_by, order):
            column, value = F.col(name), key[name]
            if ascending:
                later = column.isNotNull() if value is None else column > value
            else:
                later = F.lit(False) if value is None else (column < value) | column.isNull()
            comes_after.append(same & later)
            same = same & (column.isNull() if value is None else column == value)
        (first, ascending), *_ = _key_columns(sort_by, order)
        if key[first] is not None:
            rows = rows.filter(F.col(first) >= key[first] if ascending else (F.col(first) <= key[first]) | F.col(first).isNull())
        elif not ascending:
            rows = rows.filter(F.col(first).isNull())
        rows = rows.filter(reduce(or_, (F.coalesce(c, F.lit(False)) for c in comes_after)))
    return rows.orderBy(*sort_order(sort_by, order)).limit(size)


def page_count(rows: DataFrame, size: int = fixed.PAGE_SIZE) -> DataFrame:
    return rows.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("bigint").alias("pages"))


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the category name under each of the three fallbacks."""
    known = with_category_name(rows, names, fallback=F.lit(None).cast("string"))
    return known.select(
        *rows.columns,
        F.coalesce("category_name", F.concat(F.lit("Category "), F.col("category_id").cast("string"))).alias(
            "category_name"
        ),
        F.coalesce("category_name", F.lit(fixed.OTHER_CATEGORY)).alias("chart_category"),
        F.coalesce("category_name", F.lit(fixed.UNKNOWN_CATEGORY)).alias("table_category"),
    )


def display(rows: DataFrame) -> DataFrame:
    """Rows as shown in a table: default texts, short numbers and watch links."""
    return rows.select(
        "video_id",
        "country",
        "date",
        or_default(F.col("title"), fixed.UNTITLED).alias("title"),
        or_default(F.col("channel_title"), fixed.UNKNOWN_CHANNEL).alias("channel_title"),
        *[compact(F.col(name)).alias(name) for name in ("views", "likes", "comment_count")],
        percent(row_engagement()).alias("engagement"),
        watch_link(F.col("video_id")).alias("link"),
    )


def countries(documents: DataFrame) -> DataFrame:
    """The countries in order."""
    return documents.select("country").where("country is not null").distinct().orderBy("country")


def dates(documents: DataFrame, country: str | None = None) -> DataFrame:
    """All dates of both generations of documents, latest first, blanks left out."""
    if country:
        documents = documents.filter(F.col("country") == country)
    columns = [name for name in ("date", "trending_date") if name in documents.columns]
    either = F.explode(F.array(*columns)).alias("date")
    return documents.select(either).where("date != ''").distinct().orderBy(F.col("date").desc())


def listed_categories(documents: DataFrame) -> DataFrame:
    """(country, category_id) of the listed videos, each once."""
    return documents.select("country", F.explode("top_videos.category_id").alias("category_id")).distinct()


def categories(found: DataFrame, names: DataFrame, country: str | None = None) -> DataFrame:
    """The listed categories, of all countries or of one, with their names, by id."""
    if country:
        found = found.filter(F.col("country") == country)
    return with_category_name(found.select("category_id").distinct(), names).orderBy("category_id")


def summary(rows: DataFrame) -> DataFrame:
    """Mean engagement of the rows with views, and totals, as numbers and as text."""
    mean = F.avg(F.when(F.col("views") > 0, row_engagement()))
    totals = {"views": "total_views", "likes": "total_likes", "comment_count": "total_comments"}
    numbers = rows.agg(
        F.coalesce(mean, F.lit(0.0)).alias("mean_engagement"),
        *[zero_if_null(F.sum(name)).alias(total) for name, total in totals.items()],
    )
    texts = {f"{total}_text": compact(F.col(total)) for total in totals.values()}
    return numbers.withColumns({"mean_engagement_text": percent(F.col("mean_engagement")), **texts})


def category_share(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows and percentage per category of the listing, with its name.

    The percentage is of all rows, also those without a category, which have no name to show.
    """
    counts = rows.groupBy("category_id").agg(F.count("*").alias("count"))
    # The window holds a row for each category.
    share = F.col("count") / F.sum("count").over(Window.partitionBy()) * 100
    shares = with_category_name(counts.withColumn("share", share).where("category_id is not null"), names)
    return shares.select("category_id", "category_name", "count", one_decimal(F.col("share")).alias("percentage"))


def scatter_points(
    rows: DataFrame, sort_by="views", order="desc", n: int = fixed.SCATTER_ROWS
) -> DataFrame:
    """Chart points of the first n rows of the listing: views, engagement and a bounded bubble size."""
    first = sortable(rows, sort_by).orderBy(*sort_order(sort_by, order)).limit(n)
    position = F.row_number().over(Window.partitionBy().orderBy(*sort_order(sort_by, order)))
    return first.withColumn("position", position).select(
        "position",
        zero_if_null(F.col("views")).alias("x"),
        row_engagement().alias("y"),
        clamp(zero_if_null(F.col("comment_count")), 10, 300).alias("z"),
        or_default(F.col("title"), fixed.UNTITLED).alias("title"),
        or_default(F.col("channel_title"), fixed.UNKNOWN_CHANNEL).alias("channel"),
        "category_id",
    )


def scatter_groups(points: DataFrame, names: DataFrame, k: int = fixed.SCATTER_GROUPS) -> DataFrame:
    """The points of the k largest categories; equal sizes go by first appearance. There are few points."""
    by_name = Window.partitionBy("name")
    by_size = Window.partitionBy().orderBy(F.col("size").desc(), "first_position")
    return (
        with_category_name(points, names)
        .withColumn("name", F.coalesce("category_name", F.lit(fixed.OTHER_CATEGORY)))
        .withColumns({"size": F.count("*").over(by_name), "first_position": F.min("position").over(by_name)})
        .withColumn("group", F.dense_rank().over(by_size))
        .filter(F.col("group") <= k)
        .select("group", "name", "size", *points.columns)
    )
