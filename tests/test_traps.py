"""Missing values, calendar edges and other places where engines differ."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.functions.measures import aridity_class, share
from agroflow.operators import cleaning, climate, events, features, metrics, rows
from agroflow.sources.tables import nan_to_null

NAN = float("nan")


def climate_table(spark, data):
    return nan_to_null(spark.createDataFrame(data, "id bigint, date date, prec double, tavg double"))


def test_missing_rain_is_not_a_wet_day(spark):
    days = [date(2015, 5, d) for d in (1, 2, 3, 4)]
    df = climate_table(spark, [(1, d, p, 1.0) for d, p in zip(days, [NAN, None, 0.0, 1.5])])
    assert [tuple(r) for r in climate.precipitation_days(df).collect()] == [(1, 2015, 1)]


def test_missing_keys_are_no_group(spark):
    df = climate_table(spark, [(None, date(2015, 5, 1), 1.0, 1.0), (1, None, 1.0, 1.0), (1, date(2015, 5, 1), 1.0, 1.0)])
    assert climate.precipitation_days(df).count() == 1
    assert climate.season_totals(df, "spring").count() == 1


def test_quality_filter_keeps_missing_yield(spark):
    df = spark.createDataFrame(
        [(1, None, 200.0, 1, 200.0, 1), (2, 1000.0, 200.0, 1, 200.0, 1), (3, 999.9, 200.0, 1, 200.0, 1),
         (4, 2000.0, 140.0, 3, 200.0, 1), (5, 2000.0, 200.0, 1, 140.0, 3), (6, 2000.0, 69.0, 2, 200.0, 1),
         (7, 2000.0, 70.0, 2, 200.0, 1), (8, 2000.0, None, 3, None, 3), (9, 2000.0, 141.0, 3, 141.0, 3)],
        "id int, y double, n_synthamount double, n_synth_replication int, n_org_amount double, n_org_replication int",
    )
    kept = cleaning.reject_implausible(df, "y")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 7, 8, 9]


def test_ratio_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (50.0, 0.0), (None, 10.0), (30.0, 10.0)], "a double, b double")
    assert [r[0] for r in df.select(share(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, 0.0, 0.75]


def test_season_absent_is_null_and_all_missing_is_zero(spark):
    df = climate_table(spark, [(1, date(2014, 12, 5), NAN, 1.0), (1, date(2015, 1, 5), None, 2.0),
                               (1, date(2015, 8, 5), 4.0, 3.0)])
    row = climate.season_totals(df, "winter").first()
    assert row["harvest_year"] == 2015
    assert row["total_precipitation_winter"] == 0.0
    assert row["total_average_temperature_winter"] == 3.0
    assert row["total_precipitation_spring"] is None
    assert row["total_precipitation_autumn"] is None
    assert row["total_precipitation_year"] == 4.0  # October to September, August is inside
    assert row["total_precipitation_growing_season"] == 0.0


def test_edge_years_and_calendars(spark):
    df = climate_table(spark, [(1, date(y, 11, 1), 1.0, 1.0) for y in (2009, 2010, 2020)])
    winter = climate.season_totals(df, "winter").collect()
    assert [r["harvest_year"] for r in winter] == [2011]
    spring = climate.season_totals(df, "spring").collect()
    assert sorted(r["harvest_year"] for r in spring) == [2009, 2020]
    with pytest.raises(ValueError):
        climate.season_totals(df, "summer")


def test_season_pass_equals_separate_aggregates(spark, same):
    from checks.views import Tables

    df = Tables(spark, "/root/testdata/sf0.001").climate
    whole = climate.season_totals(df, "spring", ())
    keyed = df.withColumn("harvest_year", F.year("date"))
    expected = keyed.groupBy("id", "harvest_year").agg(
        F.sum(F.coalesce("prec", F.lit(0.0))).alias("total_precipitation_year"),
        F.sum(F.coalesce("tavg", F.lit(0.0))).alias("total_average_temperature_year"),
    )
    for season, months in {"growing_season": range(3, 9), "spring": (3, 4, 5), "summer": (6, 7, 8)}.items():
        part = keyed.where(F.month("date").isin(*months)).groupBy("id", "harvest_year").agg(
            F.sum(F.coalesce("prec", F.lit(0.0))).alias(f"total_precipitation_{season}"),
            F.sum(F.coalesce("tavg", F.lit(0.0))).alias(f"total_average_temperature_{season}"),
        )
        expected = expected.join(part, ["id", "harvest_year"], "left")
    same(whole, expected)


def test_aridity_classes_and_gaps(spark):
    values = [27.9, 28.0, 31.05, 31.055, 31.06, 35.0, 35.1, 45.0, 45.1, 55.0, 55.1, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(aridity_class(F.col("v"))).collect()]
    assert got == ["Unknown", "1", "1", "Unknown", "2", "2", "3", "3", "4", "4", "Unknown", "Unknown"]


def event_table(spark, dates):
    """One id per date, in the first manure slot."""
    columns = ", ".join(f"{schemas.date_column(s)} date" for s in schemas.EVENT_SLOTS)
    data = [(i, 1, d, *[None] * 5) for i, d in enumerate(dates)]
    return spark.createDataFrame(data, f"id int, climate_id bigint, {columns}")


@pytest.mark.parametrize("method", ["cell_day", "event_day", "range"])
def test_event_windows_by_hand(spark, method):
    start = date(2014, 1, 1)
    rain = [(1, start + timedelta(d), float(d + 1), 0.0) for d in range(365) if d not in (100, 101)]
    rain.append((1, start + timedelta(101), None, 0.0))
    rain += [(1, date(2015, 1, d), 1000.0, 0.0) for d in (1, 2, 3)]
    dates = [date(2014, 1, 3), date(2014, 12, 30), start + timedelta(100), None, date(2013, 6, 1), date(2014, 6, 1)]
    got = {
        r["id"]: (r["total_precipitation_7_before_manu_1"], r["total_precipitation_3_after_manu_1"])
        for r in events.event_precipitation(event_table(spark, dates), climate_table(spark, rain), method=method).collect()
    }
    june = (date(2014, 6, 1) - start).days + 1
    assert got == {
        0: (1 + 2 + 3, 3 + 4 + 5 + 6),  # nothing from the year before
        1: (sum(range(357, 365)), 364 + 365),  # nothing from the year after
        2: (sum(range(94, 101)), 103 + 104),  # no day in the climate table on the event day
        3: (None, None),  # no date
        4: (None, None),  # no climate in that year
        5: (sum(range(june - 7, june + 1)), sum(range(june, june + 4))),
    }


def test_event_dates(spark):
    df = spark.createDataFrame(
        [(2015, 260, -20.0, 1.5), (2015, 5, -10.0, None), (2016, None, 1.0, 1.0)],
        "year int, planting_dayofyear bigint, manu_daytoplanting_1 double, fert_daytoplanting_1 double",
    )
    df = rows.ensure_columns(df, [schemas.offset_column(s) for s in schemas.EVENT_SLOTS], 0.0)
    got = [(r["manu_date_1"], r["fert_date_1"]) for r in events.add_event_dates(df).collect()]
    jan = date(2014, 1, 1)
    assert got == [(jan + timedelta(239), jan + timedelta(260)), (date(2013, 12, 26), None), (None, None)]
    same_year = events.add_event_dates(df, year_shift=0).first()
    assert same_year["manu_date_1"] == date(2015, 1, 1) + timedelta(239)


def test_event_fill_marks_unmeasured(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], f"id int, {schemas.EVENT_PRECIPITATION[0]} double")
    filled = features.fill_event_precipitation(df).orderBy("id").collect()
    assert [r[schemas.EVENT_PRECIPITATION[0]] for r in filled] == [-1.0, 3.0]
    assert {filled[1][c] for c in schemas.EVENT_PRECIPITATION[1:]} == {-1.0}


def test_fold_deviation_is_of_the_population(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1.0, 1.0), ("a", 2, 3.0, 3.0, 3.0)],
                               "target string, fold int, rmse double, mae double, r2 double")
    row = metrics.cv_summary(df).first()
    assert (row["mean_rmse"], row["std_rmse"]) == (2.0, 1.0)


def test_metrics_in_closed_form(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 5.0), ("b", 5.0, 5.0), ("c", 5.0, 4.0)],
                               "target string, y double, y_pred double")
    got = {r["target"]: (r["n"], r["rmse"], r["mae"], r["r2"]) for r in metrics.regression_metrics(df).collect()}
    assert got == {"a": (2, 0.5**0.5, 0.5, 0.5), "b": (2, 0.0, 0.0, 1.0), "c": (1, 1.0, 1.0, 0.0)}


def test_report_puts_the_mean_last(spark):
    data = [("a", f, float(f), 1.0, 1.0) for f in (1, 2, 10)]
    df = spark.createDataFrame(data, "target string, fold int, rmse double, mae double, r2 double")
    got = [(r["fold"], r["rmse"]) for r in metrics.cv_report(df).collect()]
    assert got == [("1", 1.0), ("2", 2.0), ("10", 10.0), ("OOF", 13 / 3)]


def test_strict_drop_and_overlap(spark):
    df = spark.createDataFrame([(1, 2)], "id int, a int")
    with pytest.raises(ValueError, match="b"):
        rows.drop_strict(df, ["a", "b"])
    left, right = rows.suffix_overlap(df, df, ["id"])
    assert left.columns == ["id", "a_x"] and right.columns == ["id", "a_y"]
