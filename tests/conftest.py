import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared):
    from hitparade.session import local_session

    session = local_session(8, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def observe(spark):
    """Cleaned observations from partial rows; missing fields are null."""
    from hitparade.schemas import OBSERVATION
    from hitparade.sources.snapshots import load_filter

    def build(*rows, clean=True):
        from hitparade.operators.cleaning import clean as cleaned

        full = [tuple({"video_id": "v", "title": "t", "country": "US", "views": 1, **row}.get(name) for name in OBSERVATION.names) for row in rows]
        loaded = load_filter(spark.createDataFrame(full, OBSERVATION))
        return cleaned(loaded) if clean else loaded

    return build
