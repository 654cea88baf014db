import csv
import json
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hitparade.operators import listing, trends, words
from hitparade.plans import batch, serving
from hitparade.plans.batch import run_batch, run_days, stored_observations
from hitparade.plans.training import run_training
from hitparade.schemas import RAW_SNAPSHOT, TOP_VIDEO
from hitparade.session import cut_lineage, scratch, shared_folder
from hitparade.sinks.publication import Publication, tidy
from hitparade.sinks.tables import normalised, write_metrics
from hitparade.sources.results import read_table
from hitparade.sources.snapshots import flat_directory
from hitparade.sources.versions import latest, table_path
from tests.conftest import SMALL
from workload import adapters
from workload.queries import AS_OF, QUERIES, requests

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The observations of the test tables, written as snapshot files and run through the batch."""
    source, root = tmp_path_factory.mktemp("csv"), str(tmp_path_factory.mktemp("tables"))
    rows = adapters.observations(spark, SMALL).toPandas()
    for region in REGIONS:
        part = rows[rows.country == region][RAW_SNAPSHOT.names]
        for name in ("category_id", "views", "likes"):
            part[name] = part[name].astype("Int64")
        part.to_csv(source / f"{region}videos.csv", index=False)
    for file in adapters.category_files(spark, SMALL).collect():
        items = [{"id": i["id"], "snippet": {"title": i["snippet"]["title"]}} for i in file["items"]]
        (source / file["file"]).write_text(json.dumps({"items": items}))
    countries = (*REGIONS, "NOWHERE")
    summary = run_batch(spark, flat_directory(source, countries), root, countries, categories=str(source))
    return root, summary


def same(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.select(left.columns).collect()))


def test_batch_summary(stored):
    _, summary = stored
    assert summary == {
        "missing": ["NOWHERE"],
        "observations": 5832,
        "ml_features": True,
        "trending_results": True,
        "wordcloud_data": True,
    }


def test_stored_observations(spark, stored):
    root, _ = stored
    expected = adapters.cleaned(spark, SMALL).drop("l_orderkey", "l_linenumber")
    assert same(expected, stored_observations(spark, root))


def test_stored_results(spark, stored):
    root, _ = stored
    documents = serving.documents(spark, root)
    assert same(QUERIES["trend_documents"](spark, SMALL), trends.flattened(documents))
    assert same(QUERIES["ml_features"](spark, SMALL).drop("log_views"), read_table(spark, root, "ml_features"))
    assert same(
        words.wordcloud_documents(adapters.cleaned(spark, SMALL), stamp="x").drop("processed_at"),
        read_table(spark, root, "wordcloud_data"),
    )
    report = read_table(spark, root, "quality_report")
    assert same(QUERIES["quality_report"](spark, SMALL), report)


def test_questions(spark, stored):
    root, _ = stored
    assert [r.country for r in serving.countries(spark, root).collect()] == list(REGIONS)
    assert same(QUERIES["categories"](spark, SMALL), serving.categories(spark, root))
    assert same(QUERIES["dates"](spark, SMALL), serving.dates(spark, root))
    assert same(QUERIES["listing_by_likes"](spark, SMALL), serving.trending(spark, root, sort_by="likes"))
    assert same(QUERIES["statistics_country"](spark, SMALL), serving.country_statistics(spark, root, "ASIA"))
    assert same(QUERIES["table_counts"](spark, SMALL), serving.sizes(spark, root))
    assert serving.words(spark, root, "ASIA").count() == 1
    assert same(QUERIES["statistics_all"](spark, SMALL), serving.country_statistics(spark, root))
    page = serving.page(spark, root, 3)
    assert same(QUERIES["listing_page"](spark, SMALL), page) and page.columns[-1] == "table_category"
    assert same(QUERIES["listing_pages"](spark, SMALL), serving.pages(spark, root))
    assert same(QUERIES["category_share"](spark, SMALL), serving.category_share(spark, root))
    assert same(QUERIES["listing_words"](spark, SMALL), serving.title_words(spark, root))
    assert same(QUERIES["scatter_groups"](spark, SMALL), serving.scatter(spark, root))
    whole = QUERIES["listing_summary"](spark, SMALL).drop("mean_engagement")
    assert same(whole, serving.summary(spark, root))
    asian = serving.filtered(spark, root, country="ASIA", category=7)
    assert same(QUERIES["listing_filtered"](spark, SMALL), asian.orderBy(F.col("views").desc()).limit(200))
    single = trends.flattened(serving.group(spark, root, "ASIA", "2017-03-01"))
    assert same(QUERIES["trend_for_group"](spark, SMALL), single)


def test_training_and_scoring(spark, stored, shared):
    root, _ = stored
    before = len(_history(spark, root))
    metrics = run_training(spark, root, stamp="2020-01-01T00:00:00")
    assert metrics["dataset_size"] == 5832 and metrics["training_timestamp"] == "2020-01-01T00:00:00"
    assert -1 <= metrics["clustering"]["silhouette_score"] <= 1 and metrics["clustering"]["num_clusters"] == 3
    assert metrics["regression"]["rmse"] >= metrics["regression"]["mae"]
    left = [p for p in Path(shared, "hitparade").rglob("*.parquet")] if Path(shared, "hitparade").exists() else []
    run_training(spark, root)
    after = [p for p in Path(shared, "hitparade").rglob("*.parquet")]
    assert len(after) == len(left)
    assert len(_history(spark, root)) == before + 2
    latest = spark.read.text(f"{root}/metrics/latest").collect()
    assert len(latest) == 1 and json.loads(latest[0].value)["dataset_size"] == 5832
    scored = serving.predictions(adapters.metadata(spark, SMALL).drop("tag_list"), root)
    assert scored.filter("predicted_days >= 0 and cluster between 0 and 2").count() == 5832
    resolved = serving.metadata_predictions(adapters.metadata(spark, SMALL), root, AS_OF)
    inputs = "video_id", "country", "views", "tags", "publish_hour", "video_age_proxy"
    assert same(requests(spark, SMALL).select(*inputs), resolved.select(*inputs))
    assert [r.importance for r in serving.importance(root, 3).collect()] == [r.importance for r in serving.importance(root).collect()][:3]
    assert serving.metrics(spark, root).first()["dataset_size"] == 5832
    history = serving.metrics_history(spark, root).collect()
    assert len(history) == before + 2 and history[-1]["training_timestamp"] == "2020-01-01T00:00:00"


def _history(spark, root):
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{root}/metrics/history").collect()
    except AnalysisException:
        return []


def test_no_training_without_enough_rows(spark, tmp_path, observe):
    assert run_training(spark, str(tmp_path)) is None
    from hitparade.operators.features import ml_features

    ml_features(observe({})).write.parquet(f"{tmp_path}/ml_features")
    assert run_training(spark, str(tmp_path)) is None


def test_empty_results_keep_the_old_table(spark, tmp_path):
    rows, root = spark.range(3), str(tmp_path)
    for kept in (rows, rows.filter("false")):
        with Publication(spark, root) as new:
            assert new.write(kept, "t", keep_if_empty=True) == kept.count()
    assert spark.read.parquet(table_path(spark, root, "t")).count() == 3
    with Publication(spark, root) as new:
        new.write(rows.filter("false"), "t")
    assert spark.read.parquet(table_path(spark, root, "t")).count() == 0


def test_a_run_that_fails_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    with Publication(spark, root) as new:
        new.write(spark.range(3), "a")
        new.write(spark.range(4), "b")
    with pytest.raises(ZeroDivisionError), Publication(spark, root) as new:
        new.write(spark.range(30), "a")
        raise ZeroDivisionError
    size = lambda name: spark.read.parquet(table_path(spark, root, name)).count()
    assert (size("a"), size("b")) == (3, 4) and latest(spark, root)[0] == 1


def test_of_two_runs_at_a_time_only_one_publishes(spark, tmp_path):
    root = str(tmp_path)
    first, second = Publication(spark, root), Publication(spark, root)
    first.write(spark.range(1), "t")
    second.write(spark.range(2), "t")
    second.publish()
    with pytest.raises(RuntimeError):
        first.publish()
    assert spark.read.parquet(table_path(spark, root, "t")).count() == 2


def test_tidy_deletes_what_no_recent_list_names(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        with Publication(spark, root) as new:
            new.write(spark.range(n), "t")
            if n == 0:
                new.write(spark.range(9), "stays")
    Publication(spark, root).write(spark.range(1), "left")
    assert len(tidy(spark, root)) == 2 and latest(spark, root)[0] == 4 and tidy(spark, root) == []
    read = lambda name: spark.read.parquet(table_path(spark, root, name)).count()
    assert (read("t"), read("stays")) == (3, 9)
    assert len(tidy(spark, root, unpublished=True)) == 1 and len(list(tmp_path.rglob("left"))) == 0


def write_days(folder, rows):
    """One snapshot file for each country of the rows (country, RAW_SNAPSHOT values)."""
    folder.mkdir()
    for country in {r[0] for r in rows}:
        with (folder / f"{country}videos.csv").open("w", newline="") as file:
            csv.writer(file, lineterminator="\n").writerows([RAW_SNAPSHOT.names, *(r[1:] for r in rows if r[0] == country)])


def as_snapshot(country, day, video, views, title):
    return [country, video, day, title, "ch", 1, "2017-11-13T17:13:01.000Z", "a|b", views, 1, 1, 1, "l", "False", "True", "False", "d"]


#: The days of a first load and of a second one, which has a day anew, a new country, and rows without a date.
FIRST = [("US", "17.14.11", f"v{i}", 10 + i, f"red car {i % 3}") for i in range(15)] + [("US", "17.15.11", "v1", 7, "blue"), ("GB", "17.14.11", "g", 3, "tea"), ("US", "bad", "x", 1, "odd")]
SECOND = [("US", "17.15.11", f"w{i}", 5 * i, "green tree") for i in range(4)] + [("US", "17.16.11", "n", 2, "new day"), ("DE", "17.16.11", "d", 8, "haus"), ("US", "bad", "y", 1, "odder")]


def contents(spark, root):
    names = "raw_videos", "ml_features", "trending_results", "wordcloud_data", "day_totals", "country_totals", "listed_categories", "listed_videos"
    return {name: sorted(map(repr, read_table(spark, root, name).drop("processed_at").collect())) for name in names}


def test_new_days_equal_a_full_run(spark, tmp_path):
    write_days(tmp_path / "first", [as_snapshot(*r) for r in FIRST])
    write_days(tmp_path / "second", [as_snapshot(*r) for r in SECOND])
    replaced = {r[:2] for r in SECOND if r[1] != "bad"}
    write_days(tmp_path / "all", [as_snapshot(*r) for r in FIRST if r[:2] not in replaced] + [as_snapshot(*r) for r in SECOND])
    root, full = str(tmp_path / "tables"), str(tmp_path / "full")
    run_days(spark, flat_directory(tmp_path / "first"), root)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(table_path(spark, root, "raw_videos")).rglob("*.parquet")}
    before = files()
    summary = run_days(spark, flat_directory(tmp_path / "second"), root)
    run_batch(spark, flat_directory(tmp_path / "all"), full)
    assert summary["observations"] == len(SECOND) and contents(spark, root) == contents(spark, full)
    after = files()
    kept = [p for p in before if "2017-11-14" in str(p)]
    assert len(kept) >= 2 and all(after[p] == before[p] for p in kept)
    run_days(spark, flat_directory(tmp_path / "second"), root)
    assert contents(spark, root) == contents(spark, full)


def test_new_days_store_their_rows_once_on_the_way(spark, tmp_path, monkeypatch):
    write_days(tmp_path / "first", [as_snapshot(*r) for r in FIRST])
    write_days(tmp_path / "second", [as_snapshot(*r) for r in SECOND])
    root, sizes = str(tmp_path / "tables"), []
    run_batch(spark, flat_directory(tmp_path / "first"), root)

    @contextmanager
    def counted(session):
        with scratch(session) as cut:

            def counting(rows, **options):
                stored = cut(rows, **options)
                if "description" in stored.columns:
                    sizes.append(stored.count())
                return stored

            yield counting

    monkeypatch.setattr(batch, "scratch", counted)
    run_days(spark, flat_directory(tmp_path / "second"), root)
    undated = spark.read.parquet(table_path(spark, root, "raw_videos")).where("trending_date_parsed is null").count()
    assert sizes[0] == len(SECOND) and sum(sizes[1:]) <= undated


def test_a_run_of_days_that_dies_keeps_the_other_days(spark, tmp_path, monkeypatch):
    write_days(tmp_path / "first", [as_snapshot(*r) for r in FIRST])
    write_days(tmp_path / "second", [as_snapshot(*r) for r in SECOND])
    root = str(tmp_path / "tables")
    run_batch(spark, flat_directory(tmp_path / "first"), root)
    before = contents(spark, root)
    monkeypatch.setattr(batch, "_write_derived", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_days(spark, flat_directory(tmp_path / "second"), root)
    now = contents(spark, root)
    assert all(now[name] == before[name] for name in ("trending_results", "wordcloud_data", "day_totals", "country_totals", "listed_videos"))
    assert {r for r in before["raw_videos"] if "2017-11-14" in r} <= set(now["raw_videos"])
    monkeypatch.undo()
    with pytest.raises(ZeroDivisionError), monkeypatch.context() as m:
        m.setattr(batch, "_write_derived", lambda *_: 1 / 0)
        run_batch(spark, flat_directory(tmp_path / "second"), root)
    assert contents(spark, root) == now


def test_metrics_of_a_run_are_kept_once(spark, tmp_path):
    metrics = spark.createDataFrame([("2020", 5)], "training_timestamp string, dataset_size long")
    assert write_metrics(metrics, str(tmp_path), "one")
    assert not write_metrics(metrics, str(tmp_path), "one")
    assert write_metrics(metrics, str(tmp_path), "two")
    history = serving.metrics_history(spark, str(tmp_path)).collect()
    assert sorted(r.run_id for r in history) == ["one", "two"]


def test_pages_by_key_are_the_pages(spark, stored):
    root, _ = stored
    for how in ({}, {"sort_by": "engagement", "order": "asc"}, {"sort_by": "likes"}):
        key, where = None, {"country": "ASIA", "category": 7}
        for number in range(1, serving.pages(spark, root, **where).first()["pages"] + 1):
            page, other = serving.page(spark, root, number, **how, **where), serving.page_after(spark, root, key, **how, **where)
            assert page.collect() == other.select(page.columns).collect()
            key = listing.page_key(other.tail(1)[0], **how)
        assert serving.page_after(spark, root, key, **how, **where).count() == 0


def test_keys_with_nulls_and_ties(spark):
    videos = [(v, c, n) for v in ("a", None, "b") for c in ("x", None) for n in (3, None, 3, 1)]
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in TOP_VIDEO.fields] + ["country string", "date string"]
    full = [tuple({"video_id": v, "country": c, "views": n, "likes": i % 4}.get(f.split()[0]) for f in fields) for i, (v, c, n) in enumerate(videos)]
    rows = spark.createDataFrame(full, ", ".join(fields))
    for order in ("asc", "desc"):
        whole = rows.orderBy(*listing.sort_order("views", order)).collect()
        for at in range(0, len(whole), 5):
            key = listing.page_key(whole[at - 1], "views", order) if at else None
            assert listing.page_after(rows, key, "views", order, size=5).collect() == whole[at : at + 5]


def test_a_run_without_rows_empties_only_the_observations(spark, tmp_path):
    source, root = tmp_path / "csv", str(tmp_path / "tables")
    source.mkdir()
    header = ",".join(RAW_SNAPSHOT.names) + "\n"
    (source / "USvideos.csv").write_text(header + "a,17.14.11,red car,ch,1,x,t,5,1,1,1,l,False,True,False,d\n")
    assert run_batch(spark, flat_directory(source), root)["trending_results"]
    (source / "USvideos.csv").write_text(header + "a,17.14.11,red car,ch,1,x,t,-5,1,1,1,l,False,True,False,d\n")
    summary = run_batch(spark, flat_directory(source), root)
    assert (summary["observations"], summary["ml_features"], summary["wordcloud_data"]) == (0, False, False)
    assert serving.documents(spark, root).count() == 1 and serving.country_statistics(spark, root).collect() == []


def test_lineage_is_cut_in_the_folder_that_the_session_names(spark, shared):
    assert shared_folder(spark) == shared
    assert cut_lineage(spark.range(3)).inputFiles()[0].startswith(f"file://{shared}/hitparade/")


def test_scratch_tables_are_deleted(spark, shared):
    with scratch(spark) as cut:
        rows = cut(spark.range(3))
        path = Path(rows.inputFiles()[0].removeprefix("file://")).parent
        assert rows.count() == 3 and path.is_relative_to(shared)
    assert not path.exists() and not path.parent.exists()


def test_normalised(spark):
    rows = spark.range(1).select(F.lit(float("nan")).alias("x"), F.to_date(F.lit("2018-01-02")).alias("d"))
    assert tuple(normalised(rows).first()) == (None, "2018-01-02")


def test_steps_leave_no_shuffle_files(spark, tmp_path):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in blocks.mkString(",").split(",") if name.startswith("shuffle_")}

    rows, before = spark.range(1000).withColumn("country", F.col("id") % 3), shuffles()
    with scratch(spark) as cut:
        assert cut(rows.repartition(4, "id")).count() == 1000
    assert cut_lineage(rows.repartition(4, "id")).count() == 1000
    adapters.write_csv(rows.repartition(4, "id"), str(tmp_path / "files"))
    with Publication(spark, str(tmp_path / "tables")) as new:
        new.write(rows.repartition(4, "id"), "rows", ["country"])
        new.replace_partitions(rows.repartition(4, "id"), "rows", ["country"])
    # Counts above shuffle too, but a row for each task.
    left = {name.split("_")[1] for name in shuffles() - before}
    assert len(left) <= 2


def test_files_of_the_first_load_are_gone_before_the_second(spark, monkeypatch):
    from workload import queries

    files, seen = [], []
    written, days = adapters.write_csv, queries.run_days
    monkeypatch.setattr(adapters, "write_csv", lambda rows, folder: files.append(folder) or written(rows, folder))
    monkeypatch.setattr(queries, "run_days", lambda *a: seen.append([Path(f).exists() for f in files]) or days(*a))
    assert QUERIES["batch_by_days"](spark, SMALL).count() > 0
    assert seen == [[False, True]]
