"""Lookups give the same rows in every physical form, and hot keys are spread."""

import pytest
from pyspark.sql import functions as F

from agroflow.operators import events, ranking, skew
from agroflow.operators.encoding import category_dictionary, encode
from agroflow.plans import preparation
from agroflow.sources.workspace import measure, stage
from checks.queries import _event_panel
from checks.views import EDGE_YEARS, Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def facts(spark):
    # A third of all rows has key 7, a fifth has none.
    key = F.when(F.col("n") % 3 == 0, 7).when(F.col("n") % 5 == 0, None).otherwise(F.col("n") % 50)
    return spark.range(3000).withColumnRenamed("id", "n").withColumn("k", key.cast("int"))


@pytest.fixture
def lookup(spark):
    return spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def test_hot_keys_are_found(facts):
    hot = skew.hot_keys(facts, ["k"], 0.1)
    counts = facts.groupBy(F.xxhash64("k").alias("h")).count().where("count >= 300").collect()
    assert hot == {r["h"]: r["count"] / 3000 for r in counts} and len(hot) == 2
    assert skew.hot_keys(facts, ["n"], 0.01) == {}
    assert skew.hot_keys(facts.where("false"), ["n"]) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(facts, lookup, how, same, plan_of):
    plain = facts.join(lookup.withColumn("k", F.col("k").cast("int")), ["k"], how)
    salted = skew.lookup_join(facts, lookup, ["k"], how, spread_by=["n"], broadcast_bytes=0)
    assert "_salt" in plan_of(salted)
    same(plain, salted)
    broadcast = skew.lookup_join(facts, lookup, ["k"], how)
    assert "BroadcastHashJoin" in plan_of(broadcast) and "_salt" not in plan_of(broadcast)
    same(plain, broadcast)


def test_even_keys_are_not_salted(spark, lookup, plan_of):
    even = spark.range(4000).select((F.col("id") % 1000).alias("k"), "id")
    assert "_salt" not in plan_of(skew.lookup_join(even, lookup, ["k"], broadcast_bytes=0))


def test_a_hot_key_is_spread_over_partitions(spark, facts, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        salted = skew.lookup_join(facts, lookup, ["k"], "left", broadcast_bytes=0)
        assert salted.count() == facts.count()
        where = salted.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(where) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_outer_joins_are_refused(facts, lookup):
    with pytest.raises(ValueError):
        skew.lookup_join(facts, lookup, ["k"], "full")


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), ("é", 2), (None, 3)], "s string, n int")
    rows, size = measure(df)
    staged = stage(df, "sizes")
    assert (staged.rows, staged.bytes) == (rows, size) == (3, 3 * 32 + 5)


def test_event_windows_without_broadcast(spark, same):
    t = Tables(spark, SMALL)
    rows = events.event_rows(_event_panel(t))
    same(
        events.event_precipitation(rows, t.climate),
        events.event_precipitation(rows, t.climate, broadcast_bytes=0),
    )


def test_event_windows_with_one_hot_cell_and_day(spark, same):
    t = Tables(spark, SMALL)
    hot = _event_panel(t).withColumn("climate_id", F.lit(3).cast("bigint"))
    rows = events.event_rows(hot)
    same(
        events.event_precipitation(rows, t.climate, broadcast_bytes=0),
        events.event_precipitation(rows, t.climate, method="range"),
    )


def test_enrichment_without_broadcast(spark, same):
    from agroflow.operators.cleaning import clean_panel
    from agroflow.operators.climate import classify_cells, join_classes, precipitation_days, season_totals
    from agroflow.operators.enrichment import cell_years, enrich

    t = Tables(spark, SMALL)
    wanted = preparation.prepare(t.outputs, t.climate, t.classes, t.sims, t.soil, "winter", EDGE_YEARS)
    features = join_classes(season_totals(t.climate, "winter", EDGE_YEARS), classify_cells(t.classes))
    same(
        wanted,
        enrich(clean_panel(t.outputs), t.sims, cell_years(features, precipitation_days(t.climate)), t.soil,
               broadcast_bytes=0),
    )


def test_encoding_without_broadcast(spark, same):
    t = Tables(spark, SMALL)
    df = t.outputs.select("id", "year", "soil", "manu_depth")
    dictionary = stage(category_dictionary(df, ["soil", "manu_depth"]), "categories").df
    same(encode(df, dictionary), encode(df, dictionary, broadcast_bytes=0))


def test_staging_of_nothing(spark):
    nothing = stage(spark.range(10).where("false"), "nothing")
    assert (nothing.rows, nothing.df.count()) == (0, 0)


def test_method_follows_the_counts():
    assert events.choose_method(event_rows=100, cell_days=700) == "event_day"
    assert events.choose_method(event_rows=1000, cell_days=700) == "cell_day"


def test_ranks_match_a_window(spark, same):
    from pyspark.sql import Window

    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(3)).alias("g"), (F.col("id") * 7919 % 5003).alias("x"))
    got = ranking.ranked(df, ["g"], ["x"])
    window = Window.partitionBy("g").orderBy("x")
    same(got, df.withColumn("rank", (F.row_number().over(window) - 1).cast("bigint")))


def test_enrichment_off_broadcast_counts_keys_on_a_narrow_table(spark, tmp_path):
    from agroflow.operators.enrichment import enrich
    from agroflow.sources.workspace import stage

    spark.range(400).selectExpr("id % 40 as id", "cast(2000 + id div 40 as int) as year", "id * 1.5 as load").write.parquet(f"{tmp_path}/panel")
    panel = spark.read.parquet(f"{tmp_path}/panel")
    sims = spark.range(40).selectExpr("id as event_id", "id % 3 as climate_id", "id % 4 as site_id", "'f' as folder")
    cells = stage(spark.range(30).selectExpr("id % 3 as climate_id", "cast(2000 + id div 3 as int) as harvest_year", "id as rain"), "cells")
    soil = stage(spark.range(4).selectExpr("id as site_id", "id as clay"), "soil")
    context = spark.sparkContext
    counts = {}
    for limit in (0, 1 << 20):
        context.setJobGroup(f"enrich-{limit}", "test")
        joined = enrich(panel, sims, cells, soil, broadcast_bytes=limit)
        counts[limit] = len(context.statusTracker().getJobIdsForGroup(f"enrich-{limit}"))
        context.setLocalProperty("spark.jobGroup.id", None)
        assert joined.count() == 400
    assert counts[0] <= 24 and counts[1 << 20] <= 4
