"""The test tables in the shape of the engine's inputs."""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.operators.cleaning import clean
from hitparade.schemas import RAW_SNAPSHOT
from hitparade.session import file_system, shuffles_deleted
from hitparade.sources.categories import category_names
from hitparade.sources.snapshots import load_filter

SHIFT_YEARS = 20


# Schemas of the test tables, so that opening one takes no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as videos trending in the buyer's region in the month of shipping.

    Orders get their region before they meet the line items, so the large table is joined once per key.
    """
    t = {name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = t["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    orders = (
        t["orders"]
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "r_name")
    )
    parts = t["part"].select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    sellers = t["supplier"].select("s_suppkey", "s_name")
    items = (
        t["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    )

    def every(n):
        return F.col("l_orderkey") % n == 0

    video_id = F.concat(F.lit("v"), F.col("l_partkey").cast("string"))
    month = F.trunc(F.add_months(F.to_date("l_shipdate"), 12 * SHIFT_YEARS), "month")
    hour = F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0")
    ordered = F.date_format(F.add_months("order_date", 12 * SHIFT_YEARS), "yyyy-MM-dd")
    tags = F.when(F.col("l_returnflag") == "A", "").when(
        F.col("l_returnflag") == "R", F.concat_ws("|", "p_brand", "p_type", "l_linestatus")
    )
    price = F.col("l_extendedprice")
    columns = {
        "video_id": video_id,
        "trending_date": F.date_format(month, "yy.dd.MM"),
        "title": F.when(~every(97), F.concat_ws(" ", "p_name", "p_type")),
        "channel_title": F.when(~every(83), F.col("s_name")),
        "category_id": F.col("p_size").cast("int"),
        "publish_time": F.concat(ordered, F.lit("T"), hour, F.lit(":00:00.000Z")),
        "tags": tags,
        "views": F.when(every(101), None).when(every(103), -1).otherwise(F.floor(price)).cast("bigint"),
        "likes": F.when(every(89), -5).when(every(79), None).otherwise(F.floor(price * F.col("l_discount"))).cast("bigint"),
        "dislikes": F.floor(price * F.col("l_tax")).cast("bigint"),
        "comment_count": F.col("l_quantity").cast("bigint"),
        "thumbnail_link": F.concat(F.lit("https://i.example.org/"), video_id, F.lit(".jpg")),
        "comments_disabled": F.col("l_returnflag") == "A",
        "ratings_disabled": F.col("l_linestatus") == "F",
        "video_error_or_removed": F.col("l_quantity") == 1,
        "description": F.when(~every(71), F.concat_ws(" by ", "p_type", "s_name")),
    }
    return items.select(
        *[columns[name].alias(name) for name in RAW_SNAPSHOT.names],
        F.col("r_name").alias("country"),
        "l_orderkey",
        "l_linenumber",
    )


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_filter(observations(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(loaded(spark, sf_dir))


def awkward(rows: DataFrame) -> DataFrame:
    """Observations with quotes, commas and line breaks in their texts."""
    case = lambda n: F.col("l_orderkey") % 11 == n
    texts = {
        "title": F.when(case(0), F.concat(F.lit('"'), "title", F.lit('", said'))).when(case(1), F.replace("title", F.lit(" "), F.lit(",  "))),
        "description": F.when(case(2), F.concat("description", F.lit('\nand "more",\n\n, of it')))
        .when(case(3), F.concat(F.lit('\n"'), "description"))
        .when(case(4), F.lit('""'))
        .when(case(5), F.lit(" , ")),
        "channel_title": F.when(case(6), F.concat("channel_title", F.lit('"\n'))),
    }
    return rows.withColumns({name: F.coalesce(text, F.col(name)) for name, text in texts.items()})


def write_csv(rows: DataFrame, folder: str) -> str:
    """Observations as {country}videos.csv files with headers, several for a country; gives the pattern of their paths."""
    spark = rows.sparkSession
    written = f"{folder}/written"
    with shuffles_deleted(spark):
        rows.write.partitionBy("country").csv(written, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return _renamed(spark, written, folder, "*/*.csv", lambda country: f"{country}videos.csv", lambda path: path.getParent().getName().partition("=")[2])


def write_category_files(files: DataFrame, folder: str) -> str:
    """Rows (file, items) as one JSON file each; gives their folder."""
    spark = files.sparkSession
    text = F.to_json(F.struct("items")).alias("value")
    files.select(text, "file").write.partitionBy("file").text(f"{folder}/written")
    pattern = _renamed(spark, f"{folder}/written", folder, "*/*.txt", lambda name: name, lambda path: path.getParent().getName().partition("=")[2])
    return pattern.rsplit("/", 1)[0]


def _renamed(spark, written: str, folder: str, pattern: str, name, key) -> str:
    """Spark's part files under the names that the readers look for, in a folder for each part."""
    system, source = file_system(spark, f"{written}/{pattern}")
    for number, status in enumerate(system.globStatus(source)):
        target = file_system(spark, f"{folder}/files/{number}/{name(unquote(key(status.getPath())))}")[1]
        system.mkdirs(target.getParent())
        system.rename(status.getPath(), target)
    return f"{folder}/files/*/{name('*')}"


def daily_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as videos trending on a day, with the event type as country."""
    unknown = F.lit(None).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("country"),
        F.to_date("ts").alias("trending_date_parsed"),
        F.col("user_id").cast("string").alias("video_id"),
        F.floor("value").cast("bigint").alias("views"),
        unknown.alias("likes"),
        unknown.alias("comment_count"),
    )


def title_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as titles, with language and source as the group."""
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("country"), F.col("source").alias("trending_date_parsed"), F.col("text").alias("title")
    )


def category_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 nations and the 5 regions as the dictionaries of two countries."""
    sources = (("US", "nation", "n_nationkey", "n_name"), ("ca", "region", "r_regionkey", "r_name"))
    files = [
        table(spark, sf_dir, name)
        .select(
            F.col(key).cast("string").alias("id"),
            F.struct(F.col(label).alias("title")).alias("snippet"),
        )
        .agg(
            F.lit(f"{country}_category_id.json").alias("file"), F.collect_list(F.struct("id", "snippet")).alias("items")
        )
        for country, name, key, label in sources
    ]
    return files[0].unionByName(files[1])


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_names(category_files(spark, sf_dir))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as resolved video metadata: tag lists, and publish times in several forms of ISO text."""
    form = F.col("l_orderkey") % 4
    clock = F.substring("publish_time", 1, 19)
    published = (
        F.when(form == 0, F.col("publish_time"))
        .when(form == 1, clock)
        .when(form == 2, F.concat(clock, F.lit("+02:00")))
        .otherwise("unknown")
    )
    return cleaned(spark, sf_dir).select(
        "video_id",
        "country",
        "title",
        "views",
        "likes",
        "comment_count",
        "category_id",
        F.when(F.col("tags") != "", F.split("tags", r"\|")).alias("tag_list"),
        "description",
        "channel_title",
        published.alias("published_at"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses, and video links in five forms."""
    form, video = F.col("p_partkey") % 5, F.concat(F.lit("v"), F.col("p_partkey").cast("string"))
    link = (
        F.when(form == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), video, F.lit("&t=1")))
        .when(form == 1, F.concat(F.lit("https://youtu.be/"), video))
        .when(form == 2, F.concat(F.lit("https://m.youtube.com/embed/"), video, F.lit("?x=1")))
        .when(form == 3, F.concat(F.lit("https://www.youtube.com/channel/"), video))
        .otherwise(F.concat(F.lit("http://notyoutube.com/watch?list=a&v="), video, F.lit("#top")))
    )
    parts = table(spark, sf_dir, "part").select(link.alias("url"))
    return table(spark, sf_dir, "pages").select("url").union(parts)
