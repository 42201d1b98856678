import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecourt.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[4]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="4g", spark__sql__maxMetadataStringLength="10000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return dt.datetime(2001, 8, 1)


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate a column expression of one string column ``x`` for one input."""

    def evaluate(fn, x):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(x,)], "x string").select(fn(F.col("x"))).first()[0]

    return evaluate


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
