"""What a task and the driver hold stays bounded as the tables grow."""

import pytest
from pyspark.sql import functions as F

from agroflow.operators import climate, events, folds, skew
from agroflow.sources import tables, workspace

DAYS = "id bigint, date date, prec double"


@pytest.fixture()
def days(spark):
    return spark.range(600).selectExpr("id % 3 as id", "date_add(date'2001-01-01', cast(id div 3 as int)) as date", "cast(id % 7 as double) as prec")


def test_a_lookup_above_the_limit_is_not_broadcast(spark, plan_of):
    facts = spark.range(1000).selectExpr("id % 50 as k", "id")
    assert "Broadcast" not in plan_of(skew.lookup_join(facts, spark.range(50).selectExpr("id as k"), ["k"], broadcast_bytes=0))


def test_asked_days_are_not_broadcast(spark, days, plan_of):
    wanted = days.selectExpr("id as climate_id", "date as event_date")
    assert "Broadcast" not in plan_of(events.windows_by_event_day(days, wanted))


@pytest.mark.parametrize("what", [climate.rolling_precipitation, events.windows_by_cell_day])
def test_cell_years_go_to_tasks_by_the_row_count(days, what, plan_of, monkeypatch, same):
    wanted = what(days)
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 100)
    assert ", 6), REPARTITION_BY_NUM" in plan_of(what(days))
    same(wanted, what(days))


def test_rows_of_one_key_are_dealt_out(spark, monkeypatch):
    seen = []

    def ranked(df, within, order_by, name):
        seen.append((df.count(), df.select(*within, *order_by).distinct().count()))
        return plain(df, within, order_by, name)

    plain = folds.ranked
    monkeypatch.setattr(folds, "ranked", ranked)
    folded = folds.shuffled_folds(spark.range(1003).select(F.lit(1).alias("key")), ["key"])
    assert seen == [(1003, 1003)] and folded.columns == ["key", "fold"]
    assert sorted(r["count"] for r in folded.groupBy("fold").count().collect()) == [200, 200, 201, 201, 201]


TEXTS = ("1", "-7", "+3", "1.", "1.00", "0.5", "1e3", "1E-3", ".5", "5.", "1d", "2F", "0x1p3", "NaN", "-Infinity", "inf", "1-URGENT", "R12", "", " 4 ", "\t4", "4\n",
         "true", "T", "no", "Yes", "0", "2001-02-03", "2001-02-30", "2001-02-03 04:05:06", "1,5", "99999999999999999999", "e", "dd", "-", ".")


def test_texts_that_look_like_no_value_are_not_cast(spark, monkeypatch):
    df = spark.createDataFrame([(x,) for x in TEXTS], "x string")
    for kind in tables.INFERRED_TYPES:
        rows = df.select("x", tables._parsed("x", kind).cast("string").alias("a"), tables._tried("x", kind).cast("string").alias("b")).collect()
        assert [r["x"] for r in rows if r["a"] != r["b"]] == [], kind
    # A cast that always fails shows that it is not reached.
    monkeypatch.setattr(tables, "_parsed", lambda column, kind: F.raise_error(F.lit("cast")).cast(kind))
    for kind in ("bigint", "double", "boolean"):
        assert df.where("x in ('1-URGENT', 'R12')").where(tables._tried("x", kind).isNotNull()).count() == 0
