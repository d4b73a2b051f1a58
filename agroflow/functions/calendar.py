"""Calendar expressions: harvest years, seasons and event dates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CropCalendar:
    """Season name to months, and the month from which days count for the next harvest year."""

    seasons: dict[str, tuple[int, ...]]
    rollover_month: int | None = None


# Seasons of the two crop types.
CROP_CALENDARS = {
    "winter": CropCalendar(
        seasons={
            "growing_season": (10, 11, 12, 1, 2, 3, 4, 5, 6, 7),
            "autumn": (10, 11),
            "winter": (12, 1, 2),
            "spring": (3, 4, 5),
        },
        rollover_month=10,
    ),
    "spring": CropCalendar(
        seasons={
            "growing_season": (3, 4, 5, 6, 7, 8),
            "spring": (3, 4, 5),
            "summer": (6, 7, 8),
        },
    ),
}


def crop_calendar(crop_type: str) -> CropCalendar:
    if crop_type not in CROP_CALENDARS:
        raise ValueError(f"crop_type must be one of {sorted(CROP_CALENDARS)}, got {crop_type!r}")
    return CROP_CALENDARS[crop_type]


def harvest_year(date: Column, calendar: CropCalendar) -> Column:
    if calendar.rollover_month is None:
        return F.year(date)
    return F.year(date) + (F.month(date) >= calendar.rollover_month).cast("int")


def event_date(year: Column, planting_dayofyear: Column, offset: Column, year_shift: int = -1) -> Column:
    """Date of an event ``offset`` days from planting; planting is in ``year + year_shift``.

    Fractional offsets fall on the day they reach into; a missing part gives NULL.
    """
    days = F.floor(planting_dayofyear - 1 + offset).cast("int")
    return F.date_add(F.make_date(year.cast("int") + year_shift, F.lit(1), F.lit(1)), days)
