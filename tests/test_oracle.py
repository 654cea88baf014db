"""Every registered query against its SQL, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from check import compare
from tests.conftest import SMALL
from workload.oracle import ORACLE
from workload.queries import QUERIES

ROWS_ONLY = set(QUERIES) - set(ORACLE)


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, connection, name):
    assert compare(QUERIES[name](spark, SMALL), connection.sql(ORACLE[name])).startswith("ok")


def test_only_fits_and_hashed_text_go_without_sql():
    assert ROWS_ONLY == {
        "tfidf_title", "tfidf_description", "cluster_assign", "cluster_quality", "regression_quality",
        "feature_importance", "model_metrics", "score_days", "score_cluster", "score_both",
    }


def test_entry(spark):
    groups = Counter((r.country, r.trending_date_parsed) for r in entry(spark).collect())
    assert groups and max(groups.values()) == 10
