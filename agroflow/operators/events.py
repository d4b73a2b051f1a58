"""Precipitation around manure and fertiliser events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.functions.calendar import event_date
from agroflow.operators.climate import day_totals
from agroflow.operators.rows import first_per_key
from agroflow.operators.skew import BROADCAST_BYTES, lookup_join
from agroflow.sources.workspace import dealt, stage

WINDOWS = schemas.EVENT_WINDOWS


def add_event_dates(df: DataFrame, year_shift: int = -1) -> DataFrame:
    """One date column per event slot, from the planting day and the slot's offset."""
    return df.withColumns(
        {
            schemas.date_column(slot): event_date(
                F.col("year"), F.col("planting_dayofyear"), F.col(schemas.offset_column(slot)), year_shift
            )
            for slot in schemas.EVENT_SLOTS
        }
    )


def event_rows(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """The row that stands for each key: the first by year, then by cell and by the dates themselves."""
    columns = [*key, "year", "climate_id", *map(schemas.date_column, schemas.EVENT_SLOTS)]
    narrow = df.select(*dict.fromkeys(columns))
    return first_per_key(narrow, key, [c for c in narrow.columns if c not in key])


def _measured_days(climate: DataFrame) -> DataFrame:
    """One row per cell and day; days without a measured value count as absent."""
    return day_totals(climate.where(F.col("prec").isNotNull())).withColumnRenamed("id", "climate_id")


def _window_sums(windows, shift: str, value: str) -> list:
    """Sum per window of the values whose day lies ``shift`` days from the event."""
    return [F.sum(F.when(F.col(shift).between(a, b), F.col(value))).alias(label) for label, a, b in windows]


def _span(windows) -> tuple[int, int]:
    return min(a for _, a, _ in windows), max(b for _, _, b in windows)


def windows_by_cell_day(climate: DataFrame, windows=WINDOWS) -> DataFrame:
    """Window sums for every cell and day that could be an event's.

    Each day hands its rain to the event days whose windows reach it. All days
    of a cell's year are in one task (at most 366 rows), so the hand-over needs
    no further shuffle. The days are staged, and their count says into how many
    tasks they go. Windows end at the calendar year.
    """
    first, last = _span(windows)
    days = stage(_measured_days(climate).withColumn("year", F.year("date")), "measured-days")
    given = dealt(days.df, days.rows, "climate_id", "year").select(
        "climate_id", "year", "date", "prec", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("shift")
    )
    landed = given.withColumn("event_date", F.date_sub("date", F.col("shift")))
    same_year = landed.where(F.year("event_date") == F.col("year"))
    return (
        same_year.groupBy("climate_id", "year", "event_date")
        .agg(*_window_sums(windows, "shift", "prec"))
        .drop("year")
    )


def windows_by_event_day(climate: DataFrame, wanted: DataFrame, windows=WINDOWS) -> DataFrame:
    """Window sums for the distinct (cell, event day) pairs that occur, looked up day by day.

    Better than :func:`windows_by_cell_day` when events are few next to the climate table.
    """
    first, last = _span(windows)
    pairs = wanted.select("climate_id", "event_date").where(F.col("event_date").isNotNull()).distinct()
    asked = pairs.select(
        "climate_id", "event_date", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("shift")
    ).withColumn("date", F.date_add("event_date", F.col("shift")))
    # A (cell, day) is in `days` once and is asked for by at most one event day
    # per shift, so no key of this join is hot, whatever the events' skew.
    same_year = asked.where(F.year("date") == F.year("event_date"))
    # Spark takes the asked days for as few as their pairs, so it must not choose to broadcast them.
    found = same_year.hint("merge").join(_measured_days(climate), ["climate_id", "date"])
    return found.groupBy("climate_id", "event_date").agg(*_window_sums(windows, "shift", "prec"))


def windows_by_range(climate: DataFrame, wanted: DataFrame, windows=WINDOWS) -> DataFrame:
    """Window sums by joining whole cell-years and filtering days: the plain form, for cross-checks."""
    first, last = _span(windows)
    pairs = wanted.select("climate_id", "event_date").where(F.col("event_date").isNotNull()).distinct()
    asked = pairs.withColumn("year", F.year("event_date"))
    days = _measured_days(climate).withColumn("year", F.year("date"))
    joined = asked.join(days, ["climate_id", "year"]).withColumn(
        "shift", F.dayofyear("date") - F.dayofyear("event_date")
    )
    near = joined.where(F.col("shift").between(first, last))
    return near.groupBy("climate_id", "event_date").agg(*_window_sums(windows, "shift", "prec"))


def unpivot_events(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key and dated slot; a key without dates keeps its first slot."""
    slots = F.array(
        *[
            F.struct(F.lit(slot).alias("slot"), F.col(schemas.date_column(slot)).alias("event_date"))
            for slot in schemas.EVENT_SLOTS
        ]
    )
    long = events.select(*key, "climate_id", F.explode(slots).alias("event")).select(*key, "climate_id", "event.*")
    return long.where(F.col("event_date").isNotNull() | (F.col("slot") == schemas.EVENT_SLOTS[0]))


def choose_method(event_rows: int, cell_days: int) -> str:
    """The cheaper way to the window sums.

    ``cell_day`` costs by the climate table alone and wins when there are more
    event dates than cell days; ``event_day`` costs by the distinct event days.
    """
    return "cell_day" if event_rows * len(schemas.EVENT_SLOTS) > cell_days else "event_day"


def event_precipitation(
    events: DataFrame,
    climate: DataFrame,
    key: Sequence[str] = ("id",),
    windows=WINDOWS,
    method: str = "event_day",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Precipitation sums per key, event slot and window, as one wide row per key.

    ``events`` has one row per key with ``climate_id`` and the slot dates. A
    sum is NULL where no measured day falls in the window. The window table has
    at most one row per cell and day, is staged once, and is broadcast if it
    measures below ``broadcast_bytes``. See :func:`choose_method` for ``method``.
    """
    key = list(key)
    long = unpivot_events(events, key)
    if method == "cell_day":
        sums = windows_by_cell_day(climate, windows)
    elif method == "event_day":
        sums = windows_by_event_day(climate, long, windows)
    elif method == "range":
        sums = windows_by_range(climate, long, windows)
    else:
        raise ValueError(f"unknown method {method!r}")
    looked_up = lookup_join(
        long,
        stage(sums, "event-windows"),
        ["climate_id", "event_date"],
        "left",
        broadcast_bytes=broadcast_bytes,
    )
    wide = [
        F.sum(F.when(F.col("slot") == slot, F.col(label))).alias(schemas.window_column(label, slot))
        for slot in schemas.EVENT_SLOTS
        for label, _, _ in windows
    ]
    return looked_up.groupBy(*key).agg(*wide)


def join_event_features(panel: DataFrame, features: DataFrame, key: Sequence[str] = ("id",), **limits) -> DataFrame:
    """Event features back onto every row of their key."""
    return lookup_join(panel, features, key, **limits)
