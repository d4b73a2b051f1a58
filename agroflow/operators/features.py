"""Engineered features and null policy of the training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.functions.measures import share
from agroflow.operators.rows import ensure_columns, fill_nulls


def add_engineered_features(df: DataFrame) -> DataFrame:
    """Synthetic share of nitrogen, and growing-season rain times clay and times nitrogen."""
    synth, organic = F.col("n_synthamount"), F.col("n_org_amount")
    rain = F.col("total_precipitation_growing_season")
    return df.withColumns(
        {
            "synth_org_ratio": share(synth, organic).cast("float"),
            "precipitation_clay_interaction": rain * F.col("clay"),
            "precip_n_interaction": rain * F.col("total_nitrogen"),
        }
    )


def fill_types_and_targets(df: DataFrame) -> DataFrame:
    """Missing application types become a category of their own, missing targets 0."""
    df = fill_nulls(df, schemas.NO_APPLICATION, ["n_org_type", "n_synth_type"])
    return fill_nulls(df, 0, schemas.TARGETS)


def fill_event_precipitation(df: DataFrame) -> DataFrame:
    """All event columns exist and -1 marks that nothing was measured."""
    df = ensure_columns(df, schemas.EVENT_PRECIPITATION, -1.0)
    return fill_nulls(df, -1, schemas.EVENT_PRECIPITATION)


def add_squares(df: DataFrame, columns: Sequence[str] = schemas.SQUARED_COLUMNS) -> DataFrame:
    """Squares of the amounts; missing amounts and squares are 0."""
    df = ensure_columns(df, columns, 0.0)
    df = df.withColumns({f"{c}_sq": F.col(c) * F.col(c) for c in columns})
    return fill_nulls(df, 0, [*columns, *[f"{c}_sq" for c in columns]])
