import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from lakewright.session import build_session  # noqa: E402
from oracle import SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


@pytest.fixture
def customer(spark):
    return spark.read.parquet(f"{SF_DIR}/customer.parquet")


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collected(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    return collected


@pytest.fixture
def plan():
    """The physical plan as text."""

    def text(df):
        return df._jdf.queryExecution().toString()

    return text
