import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from evgraph.session import build_session  # noqa: E402

DATA = os.environ.get("EVGRAPH_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "evgraph-tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from evgraph.sources.tables import Tables

    return Tables(spark, DATA)


@pytest.fixture(scope="session")
def folder():
    return DATA
