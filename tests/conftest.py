import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from agroflow.session import with_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests")
    session = (
        with_settings(builder)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def plan(df) -> str:
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan_of():
    return plan


@pytest.fixture(scope="session")
def same():
    def check(a, b):
        assert sorted(a.columns) == sorted(b.columns)
        b = b.select(*a.columns)
        assert a.exceptAll(b).count() == 0
        assert b.exceptAll(a).count() == 0

    return check
