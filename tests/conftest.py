import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from textlode.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "textlode-tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def plan():
    """The optimised physical plan of a frame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
