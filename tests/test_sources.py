import csv
import itertools
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hitparade.schemas import RAW_SNAPSHOT
from hitparade.session import cut_lineage
from hitparade.sources import snapshots
from hitparade.sources.categories import read_categories
from hitparade.sources.results import load_models, read_training_input, training_input, with_document_date

HEADER = ",".join(RAW_SNAPSHOT.names)


def row(video_id, description="d", title="t", views=5):
    return [video_id, "17.14.11", title, "ch", 1, "2017-11-13T17:13:01.000Z", "a|b", views, 1, 1, 1, "l", "False", "True", "False", description]


def write(path, rows, quoting=csv.QUOTE_MINIMAL):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as file:
        file.write(HEADER + "\n")
        csv.writer(file, lineterminator="\n", quoting=quoting).writerows(rows)


def test_directories_and_missing_countries(spark, tmp_path):
    for country in ("US", "GB"):
        write(tmp_path / country / f"{country}videos.csv", [row(f"{country}1")])
    write(tmp_path / "US" / "GBvideos.csv", [row("stray")])
    rows = snapshots.read_snapshots(spark, snapshots.country_directories(tmp_path))
    assert {(r.video_id, r.country) for r in rows.collect()} == {("US1", "US"), ("GB1", "GB")}
    assert snapshots.missing_countries(rows) == ["CA", "DE", "FR", "IN", "JP", "KR", "MX", "RU"]


def test_flat_directory(spark, tmp_path):
    write(tmp_path / "KRvideos.csv", [row("a"), row("b")])
    write(tmp_path / "XXvideos.csv", [row("c")])
    rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path))
    assert {(r.video_id, r.country, r.views, r.ratings_disabled) for r in rows.collect()} == {
        ("a", "KR", 5, True),
        ("b", "KR", 5, True),
    }


def test_no_file_at_all(spark, tmp_path):
    with pytest.raises(AnalysisException):
        snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path)).collect()


def test_quotes_and_line_breaks_stay_in_their_field(spark, tmp_path):
    text = 'He said "hi",\nthen\n\nleft'
    write(tmp_path / "USvideos.csv", [row("a", text), row("b", '"')])
    rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path))
    assert {r.video_id: r.description for r in rows.collect()} == {"a": text, "b": '"'}


@pytest.mark.parametrize("seed", [1, 2])
def test_records_across_blocks_match_a_whole_file_reader(spark, tmp_path, seed):
    rnd = random.Random(seed)
    texts = ["plain", "two\nlines", 'a "quoted" word', '"start', 'x\n\n\ny, "z"\n', "", 'end"', "é☃", '""', ',"\n",']
    for country in ("US", "IN"):
        path = tmp_path / f"{country}videos.csv"
        with path.open("w", newline="") as file:
            file.write(HEADER + "\n")
            for i in range(250):
                text = rnd.choice(texts) if rnd.random() < 0.95 else "\n" * rnd.randint(1, 3000)
                quoting = rnd.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
                csv.writer(file, lineterminator="\n", quoting=quoting).writerow(row(f"{country}{i}", text, rnd.choice(texts)))
                if rnd.random() < 0.1:
                    file.write(f'{country}s{i},17.14.11,a 5" screen,ch,1,x,a|b,1,2,3,4,l,False,True,False,d "x y\n')
    write(tmp_path / "FRvideos.csv", [row(f"FR{i}", 'no "breaks", here') for i in range(50)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        pattern = snapshots.flat_directory(tmp_path)
        ours = snapshots.read_snapshots(spark, pattern)
        whole = spark.read.schema(RAW_SNAPSHOT).csv(pattern, header=True, escape='"', multiLine=True)
        country = F.regexp_extract("_metadata.file_path", r"([^/]+)videos\.csv$", 1)
        whole = whole.withColumn("country", country)
        assert spark.read.text(pattern).select("_metadata.file_block_start").distinct().count() > 5
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_within_a_block_are_put_together_without_a_shuffle(spark, tmp_path):
    texts = ["plain", "two\nlines", 'a "quoted" word', "x\n\n\ny", ',"\n",', "\n" * 20]
    for country in ("US", "IN"):
        write(tmp_path / f"{country}videos.csv", [row(f"{country}{i}", texts[i % 6], texts[i % 5]) for i in range(300)])
    pattern = snapshots.flat_directory(tmp_path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for size in ("3k", "100m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = snapshots.read_snapshots(spark, pattern)
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "Window" not in plan and "REPARTITION" not in plan
            found = {r.video_id: (r.title, r.description) for r in rows.collect()}
            whole = spark.read.schema(RAW_SNAPSHOT).csv(pattern, header=True, escape='"', multiLine=True).collect()
            assert len(whole) == 600 and found == {r.video_id: (r.title, r.description) for r in whole}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_quote_that_never_closes_does_not_swallow_its_file(spark, tmp_path):
    path = tmp_path / "USvideos.csv"
    lines = [f"v{i},17.14.11,t,ch,1,x,a,{i},1,1,1,l,False,True,False,d" for i in range(60)]
    lines[9] = 'v9,17.14.11,"t,ch,1,x,a,9,1,1,1,l,False,True,False,d'
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path))
    assert sorted(r.video_id for r in rows.collect()) == sorted(f"v{i}" for i in range(60))


def test_a_field_of_many_lines_comes_back_whole(spark, tmp_path):
    text = "\n".join(f"line {i}" for i in range(120_000))
    write(tmp_path / "USvideos.csv", [row("a"), row("long", text), row("b", "x\ny"), row("c")])
    (tmp_path / "GBvideos.csv").write_text(f"\n \n{HEADER}\n\ng1,17.14.11,t,ch,1,x,a,1,1,1,1,l,False,True,False,d\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path))
        assert {r.video_id: r.description for r in rows.collect()} == {"a": "d", "long": text, "b": "x\ny", "c": "d", "g1": "d"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_of_clean_blocks_are_not_shuffled(spark, tmp_path):
    """At any number of blocks: what is sent holds the exceptions only, and clean blocks are read without any."""
    for country in ("US", "GB"):
        write(tmp_path / f"{country}videos.csv", [row(f"v{i}", 'a "quoted", word') for i in range(500)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        kept = []
        rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path), lambda df: kept.append(cut_lineage(df)) or kept[-1])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastExchange") == 1
        assert kept[0].count() > 40 and kept[1].count() == 0
        write(tmp_path / "GBvideos.csv", [row(f"v{i}", "two\nlines" if i == 250 else "one") for i in range(500)])
        kept.clear()
        rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path), lambda df: kept.append(cut_lineage(df)) or kept[-1])
        assert [len(r.broken_blocks) for r in kept[1].collect()] == [1]
        assert rows.count() == 1000 and rows.where("description = 'two\nlines'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_other_headers(spark, tmp_path):
    """Each file's first line is its header, also where most files have another; it is no data in its own file only."""
    for country in ("US", "GB"):
        write(tmp_path / f"{country}videos.csv", [row("a")])
    odd = "v9,17.14.11,t,ch,1,x,a,9,1,1,1,l,False,True,False,d"
    (tmp_path / "DEvideos.csv").write_text(f"{odd}\n{odd.replace('v9', 'v8')}\n")
    with (tmp_path / "GBvideos.csv").open("a") as file:
        file.write(f"{odd}\n")
    (tmp_path / "FRvideos.csv").write_text("")
    (tmp_path / "INvideos.csv").write_text(" \n\n")
    rows = snapshots.read_snapshots(spark, snapshots.flat_directory(tmp_path))
    assert sorted((r.country, r.video_id) for r in rows.collect()) == [("DE", "v8"), ("GB", "a"), ("GB", "v9"), ("US", "a")]


def test_load_filter(observe):
    rows = observe(
        {"video_id": "ok", "trending_date": "17.14.11"},
        {"video_id": "bad date", "trending_date": "bad"},
        {"video_id": None},
        {"title": None},
        {"views": None},
        {"views": -1},
        clean=False,
    )
    assert {(r.video_id, str(r.trending_date_parsed)) for r in rows.collect()} == {("ok", "2017-11-14"), ("bad date", "None")}


def test_union_keeps_duplicates_and_goes_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    assert sorted(map(tuple, snapshots.union_sources(left, right).collect())) == [(1, "a"), (1, "a"), (2, "b")]


def test_categories(spark, tmp_path):
    def item(key, title):
        return {"id": key, "snippet": {"title": title}}

    (tmp_path / "us_category_id.json").write_text(json.dumps({"items": [item("1", "Film"), item(2, "Old"), item("2", "Cars")]}, indent=1))
    (tmp_path / "GB_category_id.json").write_text("{broken")
    (tmp_path / "DE_category_id.json").write_text(json.dumps({"items": [item("1", "Film"), {"id": "3"}]}))
    (tmp_path / "FR_category_id.json").write_text(json.dumps({}))
    found = read_categories(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [("US", "1", "Film"), ("US", "2", "Cars")]


def test_training_input_defaults(spark):
    rows = spark.createDataFrame(
        [("x", None, None, None)], "video_id string, country string, views bigint, like_ratio double"
    )
    assert training_input(rows).first().asDict() == {"video_id": "x", "country": "", "views": 0, "like_ratio": None}


def test_absent_tables_and_models(spark, tmp_path):
    assert read_training_input(spark, str(tmp_path)) is None
    assert load_models(str(tmp_path)) == {}


def test_document_date_of_both_generations(spark):
    rows = spark.createDataFrame([("a", "2018-01-01", None), ("b", None, "2018-01-02")], "k string, date string, trending_date string")
    assert [tuple(r) for r in with_document_date(rows).orderBy("k").collect()] == [("a", "2018-01-01"), ("b", "2018-01-02")]
    old = rows.select("k", "trending_date")
    assert with_document_date(old).columns == ["k", "date"]


def ends_inside(text, inside):
    """A line read sign by sign: is a quoted field open at its end?"""
    start, text = True, text.replace('""', "")
    for sign in text:
        if sign == '"':
            inside = start and not inside
        start = sign == ","
    return int(inside)


def test_open_fields_at_line_ends_are_found_without_regular_expressions(spark):
    texts = ["".join(signs) for n in range(8) for signs in itertools.product('",a', repeat=n)] + ['é","☃', ',"é"é"', '"☃,"']
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    outside, inside = snapshots._ends_inside(F.col("text"))
    found = rows.select("text", outside.alias("outside"), inside.alias("inside"))
    assert [(r.outside, r.inside) for r in found.collect()] == [(ends_inside(t, False), ends_inside(t, True)) for t in texts]
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_countries_come_from_decoded_file_names(spark, tmp_path):
    write(tmp_path / "a b+éxvideos.csvvideos.csv", [row("v", "x\ny"), row("w")])
    (tmp_path / "other.csv").write_text(f"{HEADER}\n")
    rows = snapshots.read_snapshots(spark, str(tmp_path / "*.csv"))
    assert sorted((r.video_id, r.country) for r in rows.collect()) == [("v", "a b+éxvideos.csv"), ("w", "a b+éxvideos.csv")]
