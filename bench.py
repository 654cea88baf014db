"""Time the headline queries and whole runs; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from hitparade.plans import serving
from hitparade.plans.batch import run_batch
from hitparade.plans.training import run_training
from hitparade.schemas import RAW_SNAPSHOT
from hitparade.session import local_session
from hitparade.sources.snapshots import flat_directory
from workload import adapters
from workload.queries import QUERIES

HEADLINE = (
    "load_observations", "clean_observations", "quality_report", "top_videos", "trend_stats", "trend_documents",
    "word_counts", "top_words", "wordcloud_documents", "ml_features", "cluster_features", "longevity_features",
    "scaled_features", "term_idf", "listing_by_views", "listing_by_engagement", "listing_summary", "category_share",
    "statistics_all", "score_features", "heuristic_days", "url_video_id",
)

# Published for the reference: records per second of a batch run, and average seconds per question.
PUBLISHED_RECORDS_PER_SECOND = 10_000
PUBLISHED_QUESTION_SECONDS = 0.2


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def write_snapshots(spark, sf_dir: str, folder: str) -> tuple[str, ...]:
    """The observations as one CSV file per region, as the batch reads them."""
    rows = adapters.observations(spark, sf_dir).select(*RAW_SNAPSHOT.names, "country").cache()
    regions = tuple(sorted(r.country for r in rows.select("country").distinct().collect()))
    for region in regions:
        part = rows.filter(rows.country == region).drop("country").coalesce(1)
        part.write.csv(f"{folder}/{region}", header=True, escape='"')
        (written,) = Path(folder, region).glob("*.csv")
        Path(folder, f"{region}videos.csv").hardlink_to(written)
    rows.unpersist()
    for row in adapters.category_files(spark, sf_dir).collect():
        Path(folder, row["file"]).write_text(json.dumps({"items": [item.asDict(True) for item in row["items"]]}))
    return regions


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    folder = tempfile.mkdtemp(prefix="bench-")
    root = f"{folder}/tables"
    seconds = {}

    for name in HEADLINE:
        # The second run: the first one also compiles the query's code.
        seconds[name] = [timed(lambda name=name: run(QUERIES[name](spark, sf_dir))) for _ in range(2)][-1]
        print(name, seconds[name], file=sys.stderr)

    regions = write_snapshots(spark, sf_dir, folder)
    summary = {}
    seconds["batch"] = timed(lambda: summary.update(run_batch(spark, flat_directory(folder, regions), root, regions, folder)))
    print("batch", seconds["batch"], file=sys.stderr)
    questions = {
        "countries": lambda: serving.countries(spark, root),
        "categories": lambda: serving.categories(spark, root),
        "dates": lambda: serving.dates(spark, root),
        "trending": lambda: serving.trending(spark, root, country=regions[0], sort_by="engagement"),
        "statistics": lambda: serving.country_statistics(spark, root, regions[0]),
        "wordcloud": lambda: serving.words(spark, root, regions[0]),
    }
    for name, question in questions.items():
        question().collect()
        seconds[f"ask_{name}"] = timed(lambda question=question: question().collect())
    seconds["training"] = timed(lambda: run_training(spark, root))
    print("training", seconds["training"], file=sys.stderr)

    asked = [value for name, value in seconds.items() if name.startswith("ask_")]
    result = {
        "metric": "headline queries and whole runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "batch_records_per_second": round(summary["observations"] / seconds["batch"]),
        "published_records_per_second": PUBLISHED_RECORDS_PER_SECOND,
        "mean_question_seconds": round(sum(asked) / len(asked), 3),
        "published_question_seconds": PUBLISHED_QUESTION_SECONDS,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
