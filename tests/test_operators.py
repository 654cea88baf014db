import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hitparade import fixed
from hitparade.operators import cleaning, features, listing, lookups, statistics, trends, words
from hitparade.schemas import OBSERVATION, TREND_DOCUMENT


def test_schema_checks(spark, observe):
    rows = observe({})
    assert cleaning.type_mismatches(rows).collect() == []
    changed = rows.withColumn("views", F.col("views").cast("int"))
    assert [tuple(r) for r in cleaning.type_mismatches(changed).collect()] == [("views", "int", "bigint")]
    with pytest.raises(ValueError, match="likes, tags"):
        cleaning.require_columns(rows.drop("tags", "likes"))


def test_cleaning(observe):
    row = observe({"likes": -5, "dislikes": None, "comment_count": -1}).first()
    assert (row.likes, row.dislikes, row.comment_count) == (0, None, 0)
    assert (row.description, row.tags, row.channel_title) == ("", "", "Unknown")


def test_quality_report(observe):
    rows = observe({"video_id": "a", "likes": -1}, {"video_id": "a", "likes": 3}, {"video_id": "b"}, clean=False)
    found = {(r["check"], r["column"]): r["value"] for r in cleaning.quality_report(rows).collect()}
    assert found[("total_rows", None)] == 3
    assert found[("null_count", "likes")] == 1 and found[("null_count", "dislikes")] == 3
    assert found[("negative_count", "likes")] == 1 and found[("negative_count", "views")] == 0
    assert found[("duplicate_video_ids", "video_id")] == 1
    assert cleaning.duplicate_keys(rows).first()[0] == 1


def test_quality_report_of_nothing(observe):
    rows = observe({}).filter("false")
    assert {r["value"] for r in cleaning.quality_report(rows).collect()} == {0}


DAY = {"trending_date": "17.14.11"}


def test_trend_documents(spark, observe):
    rows = observe(
        *[{"video_id": f"v{i:02}", "views": 100 - i, "likes": i, **DAY} for i in range(9)],
        {"video_id": "z2", "views": 1, **DAY},
        {"video_id": "z1", "views": 1, **DAY},
        {"video_id": "undated", "views": 999, "trending_date": "bad"},
        {"video_id": "other", "views": 7, "country": "GB", **DAY},
    )
    documents = trends.trend_documents(rows, stamp="now")
    assert documents.schema.simpleString() == TREND_DOCUMENT.simpleString()
    found = {r.country: r for r in documents.collect()}
    assert set(found) == {"US", "GB"} and found["US"].date == "2017-11-14"
    assert [v.video_id for v in found["US"].top_videos] == [f"v{i:02}" for i in range(9)] + ["z1"]
    assert found["US"].statistics.total_videos == 11 and found["US"].statistics.total_likes == 36
    assert found["GB"].top_videos[0].likes == 0 and found["GB"].statistics.total_likes == 0
    assert trends.trend_groups(rows).count() == 3


def test_one_group_equals_its_part_of_all_groups(spark):
    from tests.conftest import SMALL
    from workload.adapters import cleaned

    rows = cleaned(spark, SMALL).cache()
    every = trends.flattened(trends.trend_documents(rows)).filter("country = 'EUROPE' and date = '2017-05-01'")
    single = trends.flattened(trends.trend_for(rows, "EUROPE", "2017-05-01"))
    assert sorted(map(repr, every.collect())) == sorted(map(repr, single.collect())) != []


def test_processing_time_is_iso_text(observe):
    stamp = trends.trend_documents(observe(DAY)).first().processed_at
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}", stamp)


def test_words_of_many_scripts(observe):
    rows = observe({"title": "हिन्दी गाना 2018 Ünïcode don’t THE be the", **DAY})
    assert {r.word for r in words.word_counts(rows).collect()} == {"2018", "ünïcode", "don"}


def test_word_documents_keep_groups_without_words(observe):
    rows = observe(
        {"title": "red red blue", **DAY}, {"title": "of the", "country": "GB", **DAY}, {"title": "a b", "country": "FR", **DAY}
    )
    found = {r.country: [tuple(w) for w in r.words] for r in words.wordcloud_documents(rows).collect()}
    assert found == {"US": [("red", 2), ("blue", 1)], "GB": [], "FR": []}


def test_word_counts_against_python(spark):
    from tests.conftest import SMALL
    from workload.adapters import title_rows

    rows = title_rows(spark, SMALL)
    expected = Counter()
    for row in rows.collect():
        cleaned = "".join(c if c.isalpha() or c in "0123456789" else " " for c in row.title.lower())
        for word in cleaned.split():
            if len(word) > 2 and word not in fixed.TITLE_STOP_WORDS:
                expected[(row.country, row.trending_date_parsed, word)] += 1
    found = {(r.country, r.trending_date_parsed, r.word): r.value for r in words.word_counts(rows).collect()}
    assert found == dict(expected)


def test_wordcloud_takes_the_latest_or_a_given_date(observe):
    rows = observe({"title": "early", "trending_date": "17.01.11"}, {"title": "late", "trending_date": "17.02.11"})
    documents = words.wordcloud_documents(rows)
    assert words.wordcloud(documents).first().words[0].text == "late"
    assert words.wordcloud(documents, country="US", date="2017-11-01").first().words[0].text == "early"
    assert words.wordcloud(documents, country="GB").collect() == []


def test_listing_words_are_ascii(spark):
    rows = spark.createDataFrame([("Über_x über-all The snake_case 123",)], "title string")
    assert {r.text for r in words.listing_words(rows).collect()} == {"ber_x", "ber", "snake_case", "123"}


def test_feature_edges(observe):
    cases = {
        "bad time": {"publish_time": "x"},
        "good": {"publish_time": "2017-11-13T17:13:01.000Z"},
        "later": {"publish_time": "2017-11-18T00:00:00.000Z"},
        "no views": {"views": 0, "likes": 5},
        "no likes": {"views": 5, "comment_count": 2},
    }
    rows = observe(*[{"video_id": name, **DAY, **case} for name, case in cases.items()])
    found = {r.video_id: r for r in features.ml_features(rows).collect()}
    bad, good, later = found["bad time"], found["good"], found["later"]
    assert (bad.publish_hour, bad.publish_day_of_week, bad.video_age_days, bad.video_age_proxy) == (12, 1, 7, 4)
    assert (good.publish_hour, good.publish_day_of_week, good.video_age_days, good.video_age_proxy) == (17, 2, 1, 1)
    assert (later.video_age_days, later.video_age_proxy) == (-4, 1)
    assert found["no views"].like_ratio == found["no views"].engagement_score == found["no views"].log_views == 0.0
    assert (found["no likes"].like_ratio, found["no likes"].engagement_score, found["no likes"].comment_ratio) == (0.0, 0.0, 0.4)
    assert good.trending_date == "2017-11-14" and good.tag_count == 1


@pytest.fixture(scope="module")
def documents(spark):
    def video(key, views, likes=0, comments=0, category=1, title="red car"):
        return (key, title, "ch", views, likes, 0, comments, category, "")

    stats = (1, 1, 1.0, 1, 1, 1)
    rows = [
        ("US", "2018-01-02", "p", stats, [video("a", 100, 10, 5), video("b", 100, 50, 0, 2), video("c", 0, 9, 9, 999, "")]),
        ("GB", "2018-01-01", "p", stats, [video("d", 300, 1, 1, 2)]),
        ("FR", "2018-01-03", "p", stats, []),
    ]
    return spark.createDataFrame(rows, TREND_DOCUMENT)


@pytest.fixture(scope="module")
def names(spark):
    rows = [("US", "1", "Film"), ("US", "2", "Cars"), ("GB", "1", "Movies")]
    return spark.createDataFrame(rows, "country string, category_id string, category_name string")


def ids(rows):
    return [r.video_id for r in rows.collect()]


def test_listing_order_and_filters(documents):
    assert ids(listing.listing(documents)) == ["d", "a", "b", "c"]
    assert ids(listing.listing(documents, sort_by="foo", order="ASC")) == ["c", "a", "b", "d"]
    assert ids(listing.listing(documents, sort_by="likes")) == ["b", "a", "c", "d"]
    assert ids(listing.listing(documents, sort_by="comments", limit=2)) == ["c", "a"]
    assert ids(listing.listing(documents, sort_by="engagement")) == ["b", "a", "d", "c"]
    assert ids(listing.listing(documents, country="US", category="2")) == ["b"]
    assert ids(listing.listing(documents, date="2018-01-01")) == ["d"]
    assert len(ids(listing.listing(documents, date="  ", country=""))) == 4
    with pytest.raises(ValueError):
        listing.listing(documents, category="abc")
    with pytest.raises(ValueError):
        listing.listing(documents, limit=1001)


def test_pages(documents):
    rows = listing.listing_rows(documents)
    assert ids(listing.page(rows, 2, size=3)) == ["c"]
    assert [listing.page_count(part, size=3).first().pages for part in (rows, rows.limit(3), rows.filter("false"))] == [2, 1, 1]


def test_older_documents(documents):
    old = documents.withColumnRenamed("date", "trending_date")
    both = documents.unionByName(old, allowMissingColumns=True)
    assert ids(listing.listing(both, date="2018-01-01")) == ["d", "d"]
    assert [r.date for r in listing.dates(both).collect()] == ["2018-01-03", "2018-01-02", "2018-01-01"]
    assert [r.date for r in listing.dates(both, "GB").collect()] == ["2018-01-01"]


def test_names_and_categories(documents, names):
    rows = listing.named(listing.listing_rows(documents), names)
    found = {r.video_id: (r.category_name, r.chart_category, r.table_category) for r in rows.collect()}
    assert found["c"] == ("Category 999", "Other", "Unknown") and found["a"] == ("Film", "Film", "Film")
    found = listing.listed_categories(documents)
    categories = listing.categories(found, names)
    assert [tuple(r) for r in categories.collect()] == [(1, "Film"), (2, "Cars"), (999, "Category 999")]
    assert [r.category_id for r in listing.categories(found, names, "GB").collect()] == [2]
    british = lookups.with_category_name(listing.listing_rows(documents), names, mapping_country="GB")
    assert {r.category_name for r in british.collect()} == {"Movies", "Category 2", "Category 999"}


def test_share_counts_all_rows(documents, names):
    rows = listing.listing_rows(documents)
    rows = rows.withColumn("category_id", F.when(F.col("category_id") != 999, F.col("category_id")))
    found = {r.category_name: (r["count"], r.percentage) for r in listing.category_share(rows, names).collect()}
    assert found == {"Film": (1, "25.0"), "Cars": (2, "50.0")}


def test_summary(documents):
    row = listing.summary(listing.listing_rows(documents)).first()
    assert (row.total_views, row.total_likes, row.total_comments) == (500, 70, 15)
    assert row.mean_engagement == pytest.approx((0.15 + 0.5 + 2 / 300) / 3) and row.mean_engagement_text == "21.9%"


def test_display_defaults(documents):
    row = listing.display(listing.listing_rows(documents).filter("video_id = 'c'")).first()
    assert (row.title, row.engagement, row.views, row.link[-4:]) == ("Untitled", "0.0%", "0", "?v=c")


def test_scatter(documents, names):
    rows = listing.listing_rows(documents)
    points = listing.scatter_points(rows, n=3)
    assert [(p.position, p.x, p.z) for p in points.orderBy("position").collect()] == [(1, 300, 10), (2, 100, 10), (3, 100, 10)]
    groups = listing.scatter_groups(points, names, k=1)
    assert {(g["group"], g["name"], g["size"], g["position"]) for g in groups.collect()} == {(1, "Cars", 2, 1), (1, "Cars", 2, 3)}


def test_statistics(observe):
    rows = observe({"views": 4, "likes": 2}, {"views": 2, "country": "GB"})
    row = statistics.statistics(rows).first()
    assert (row.total_videos, row.avg_views, row.avg_likes, row.total_comments, row.max_views) == (2, 3.0, 1.0, 0, 4)
    assert statistics.statistics(rows, "GB").first().total_views == 2
    assert statistics.statistics(rows, "FR").collect() == []


def test_counts(spark, observe):
    rows = observe({"description": "d"}, {"title": ""})
    assert tuple(statistics.text_presence(rows).first()) == (1, 1, 2)
    assert tuple(statistics.text_presence(rows.drop("description")).first()) == (1, 0, 2)
    assert tuple(statistics.training_gate(rows).first()) == (2, 1000, False)
    assert tuple(statistics.training_gate(rows, required=2).first()) == (2, 2, True)
    assert {tuple(r) for r in statistics.table_counts(x=rows, y=rows.limit(1)).collect()} == {("x", 2), ("y", 1)}


def test_cluster_names(spark):
    rows = spark.createDataFrame([(0,), (7,)], "c int").select(lookups.cluster_name(F.col("c")).alias("name"))
    assert [r.name for r in rows.collect()] == [fixed.CLUSTER_NAMES[0], "Cluster 7"]


def test_observation_schema_has_country():
    assert OBSERVATION.names[-1] == "country"
