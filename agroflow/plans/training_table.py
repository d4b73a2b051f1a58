"""From the joined panel and daily climate to the model-ready table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from agroflow import schemas
from agroflow.operators.encoding import fit_encode
from agroflow.operators.events import (
    add_event_dates,
    choose_method,
    event_precipitation,
    event_rows,
    join_event_features,
)
from agroflow.operators.features import (
    add_engineered_features,
    add_squares,
    fill_event_precipitation,
    fill_types_and_targets,
)
from agroflow.operators.rows import order_columns
from agroflow.sources.workspace import stage

ENCODED = (*schemas.LABEL_COLUMNS, *schemas.ORDINAL_COLUMNS)


@dataclass(frozen=True)
class TrainingTable:
    table: DataFrame
    dictionary: DataFrame
    event_precipitation: DataFrame


def encode_categories(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fill types and targets, encode the category columns, order columns by role."""
    encoded, dictionary = fit_encode(fill_types_and_targets(df), ENCODED)
    return order_columns(encoded, [*schemas.TARGETS, *ENCODED]), dictionary


def training_table(
    panel: DataFrame,
    climate: DataFrame,
    event_key: tuple[str, ...] = ("id",),
    planting_year_shift: int = -1,
    method: str | None = None,
) -> TrainingTable:
    """The training table, its category dictionary and the event precipitation it used.

    With the default key the events of an id's first year stand for all its
    years; ``("id", "year")`` computes them year by year. Ratios and products use
    the amounts before they are encoded. The dictionary is fitted on the
    panel's own columns, before the event join, which loses no row. The method
    of the event sums follows from the two tables' row counts unless given;
    ``panel`` and ``climate`` are read more than once and should be stored tables.
    """
    dated = add_event_dates(panel, planting_year_shift)
    chosen = stage(event_rows(dated, event_key), "event-rows")
    method = method or choose_method(chosen.rows, climate.count())
    events = stage(event_precipitation(chosen.df, climate, event_key, method=method), "event-precipitation")
    unused = [c for c in schemas.UNUSED_AFTER_PREPARATION if c not in event_key]
    features = add_engineered_features(panel.drop(*unused))
    encoded, dictionary = encode_categories(features)
    joined = join_event_features(encoded, events, event_key, keys_from=panel)
    table = add_squares(fill_event_precipitation(joined))
    return TrainingTable(table, dictionary, events.df)
