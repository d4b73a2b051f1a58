"""Calendar and season aggregates of daily climate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroflow.functions.calendar import CropCalendar, crop_calendar, harvest_year
from agroflow.functions.measures import aridity_class
from agroflow.operators.rows import suffix_overlap
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import StagedTable, dealt, stage

# Measure columns with the name used in features, and the incomplete edge years.
MEASURES = {"prec": "precipitation", "tavg": "average_temperature"}
INCOMPLETE_YEARS = (2010, 2021)


def calendar_parts(climate: DataFrame) -> DataFrame:
    date = F.col("date")
    return climate.withColumns({"year": F.year(date), "month": F.month(date), "doy": F.dayofyear(date)})


def precipitation_days(climate: DataFrame) -> DataFrame:
    """Days with rain per cell and calendar year."""
    keyed = climate.where(F.col("id").isNotNull() & F.col("date").isNotNull())
    return keyed.groupBy(F.col("id").alias("climate_id"), F.year("date").alias("year")).agg(
        F.count_if(F.col("prec") > 0).alias("prec_days")
    )


def season_totals(
    climate: DataFrame,
    crop: str | CropCalendar,
    incomplete_years: Iterable[int] = INCOMPLETE_YEARS,
) -> DataFrame:
    """Yearly and seasonal sums per cell and harvest year, in one pass and one shuffle.

    A season without any day is NULL; one whose values are all missing is 0.
    """
    calendar = crop_calendar(crop) if isinstance(crop, str) else crop
    month = F.month("date")
    sums = []
    for season, months in [("year", None), *calendar.seasons.items()]:
        for measure, name in MEASURES.items():
            value = F.coalesce(F.col(measure), F.lit(0.0))
            inside = value if months is None else F.when(month.isin(*months), value)
            sums.append(F.sum(inside).alias(f"total_{name}_{season}"))
    keyed = climate.where(F.col("id").isNotNull() & F.col("date").isNotNull())
    totals = keyed.groupBy("id", harvest_year(F.col("date"), calendar).alias("harvest_year")).agg(*sums)
    return totals.where(~F.col("harvest_year").isin(*incomplete_years))


def classify_cells(classes: DataFrame) -> DataFrame:
    """Cell id and aridity class."""
    return classes.select("id", aridity_class(F.col("aridity_index")).alias("Class"))


def join_classes(totals: DataFrame, classes: DataFrame | StagedTable) -> DataFrame:
    return lookup_join(totals, classes, ["id"])


def join_simulations(sims: DataFrame, features: DataFrame | StagedTable) -> DataFrame:
    """Every simulation with the climate features of its cell, one row per harvest year.

    Simulations of cells without climate stay, with NULLs.
    """
    def by_cell(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("id", "climate_id")

    keyed = sims.withColumn("climate_id", F.col("climate_id").cast("bigint"))
    features = features.change(by_cell) if isinstance(features, StagedTable) else by_cell(features)
    keyed, features = suffix_overlap(keyed, features, ["climate_id"])
    joined = lookup_join(keyed, features, ["climate_id"], "left")
    return joined.drop("folder")


def day_totals(climate: DataFrame) -> DataFrame:
    """One row per cell and day: repeated rows are added up before the shuffle."""
    keyed = climate.where(F.col("id").isNotNull() & F.col("date").isNotNull())
    return keyed.groupBy("id", "date").agg(F.sum("prec").alias("prec"))


def rolling_precipitation(climate: DataFrame) -> DataFrame:
    """Rain of the eight days up to each day and of the four days from it, inside its calendar year.

    A window partition is one cell's year: at most 366 rows. The days are staged, and their count says into how many
    tasks the cells' years go.
    """
    window = Window.partitionBy("id", "year").orderBy(F.dayofyear("date"))
    days = stage(day_totals(climate).withColumn("year", F.year("date")), "day-totals")
    return dealt(days.df, days.rows, "id", "year").select(
        "id",
        "date",
        F.sum("prec").over(window.rangeBetween(-7, 0)).alias("prec_before"),
        F.sum("prec").over(window.rangeBetween(0, 3)).alias("prec_after"),
    )
