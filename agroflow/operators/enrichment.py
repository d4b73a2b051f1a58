"""The panel joined with simulations, climate, soil and rain days."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroflow.operators.rows import suffix_overlap
from agroflow.operators.skew import BROADCAST_BYTES, lookup_join
from agroflow.sources.workspace import StagedTable, measure, stage


def cell_years(features: DataFrame, prec_days: DataFrame) -> DataFrame:
    """Climate features and rain days of a cell and harvest year in one table.

    Both are aggregates keyed by cell and year, so this join is small and even.
    """
    left = features.withColumnRenamed("id", "climate_id")
    right = prec_days.withColumnRenamed("year", "harvest_year")
    return left.join(right, ["climate_id", "harvest_year"])


def enrich(
    panel: DataFrame,
    sims: DataFrame,
    cell_year: DataFrame | StagedTable,
    soil: DataFrame | StagedTable,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Panel rows with simulation, climate, rain-day and soil columns; rows without a match drop.

    The simulation is joined by id before it fans out over years, so the
    panel meets one row per id; the rest are lookups by (cell, year) and site.

    If a lookup is too large to broadcast, hot keys are counted on one narrow
    table of all rows' keys, written once, so the panel is not read for them again.
    """
    sims = sims.drop("folder").withColumn("climate_id", F.col("climate_id").cast("bigint"))
    cell_year, soil, sims = (x if isinstance(x, StagedTable) else StagedTable(x, *measure(x)) for x in (cell_year, soil, sims))

    @cache
    def keys() -> DataFrame:
        ids = stage(panel.select("id", "year"), "panel-keys").df
        by_id = sims.df.select(F.col("event_id").alias("id"), "climate_id", "site_id")
        plain = F.broadcast(by_id) if sims.bytes <= broadcast_bytes else by_id
        return stage(ids.withColumnRenamed("year", "harvest_year").join(plain, "id"), "enrichment-keys").df

    panel, sims = suffix_overlap(panel, sims, [])
    by_id = sims.change(lambda df: df.withColumn("id", F.col("event_id")))
    joined = lookup_join(panel, by_id, ["id"], broadcast_bytes=broadcast_bytes, keys_from=keys)

    joined = joined.withColumn("harvest_year", F.col("year"))
    for lookup, on in ((cell_year, ["climate_id", "harvest_year"]), (soil, ["site_id"])):
        joined, lookup = suffix_overlap(joined, lookup, on)
        joined = lookup_join(joined, lookup, on, broadcast_bytes=broadcast_bytes, keys_from=keys)
    return joined
