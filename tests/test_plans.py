"""Physical plans: what is read, what is shuffled, and no Python in the rows' way."""

import pytest
from pyspark.sql import functions as F

from agroflow.operators import cleaning, climate, events, rows
from agroflow.sources import tables
from checks.queries import REGISTRY, _event_panel
from checks.views import Tables

SMALL = "/root/testdata/sf0.001"
TRAINED = {"cv_train", "train_multi_target"}


@pytest.fixture
def stored_climate(spark, tmp_path):
    path = str(tmp_path / "climate")
    Tables(spark, SMALL).climate.write.parquet(path)
    return spark.read.parquet(path)


def test_seasons_take_one_shuffle(stored_climate, plan_of):
    assert plan_of(climate.season_totals(stored_climate, "winter")).count("Exchange hashpartitioning") == 1


def test_wet_days_read_only_their_columns(stored_climate, plan_of):
    plan = plan_of(climate.precipitation_days(stored_climate))
    assert "tavg" not in plan.split("ReadSchema")[1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_filter_reaches_the_scan(spark, plan_of):
    wanted = F.col("o_totalprice") > 200000
    plan = plan_of(tables.read_parquet(spark, f"{SMALL}/orders.parquet", where=wanted).select("o_orderkey"))
    assert "GreaterThan(o_totalprice,200000.0)" in plan
    assert "o_orderpriority" not in plan.split("ReadSchema")[1]


def test_nan_passes_no_pushed_filter(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([(1.0,), (float("nan"),), (None,), (9.0,)], "x double").write.parquet(path)
    got = tables.read_parquet(spark, path, where=F.col("x") > 5).collect()
    assert [r["x"] for r in got] == [9.0]


def test_cleaning_does_not_shuffle(spark, tmp_path, plan_of):
    path = str(tmp_path / "outputs")
    Tables(spark, SMALL).outputs.write.parquet(path)
    assert "Exchange" not in plan_of(cleaning.clean_panel(spark.read.parquet(path)))


def test_dedupe_reduces_before_the_shuffle(spark, plan_of):
    plan = plan_of(rows.first_per_key(spark.range(10).selectExpr("id % 3 as k", "id"), ["k"], ["id"]))
    assert "row_number(), 1, Partial" in plan


def test_events_keep_the_partitioning_of_their_key(spark, tmp_path, plan_of):
    """One shuffle by id serves the dedupe and the sums; the windows are broadcast."""
    t = Tables(spark, SMALL)
    path = str(tmp_path / "panel")
    _event_panel(t).write.parquet(path)
    plan = plan_of(events.event_precipitation(events.event_rows(spark.read.parquet(path)), t.climate))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - TRAINED))
def test_no_row_goes_through_python(spark, plan_of, name):
    plan = plan_of(REGISTRY[name](spark, SMALL))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
