"""Cleaning of raw simulator outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.functions.measures import null_if
from agroflow.operators.rows import drop_strict

RAW_YIELD = "aC_harvest_export[kgCha-1]"

# Total amount, type, applications column and event family of each kind of nitrogen.
APPLICATIONS = {
    "n_org_amount": ("n_org_type", "n_org_replication", "manu"),
    "n_synthamount": ("n_synth_type", "n_synth_replication", "fert"),
}
# Smallest accepted yield, and nitrogen limits for repeated applications.
MIN_YIELD = 1000
LOW_NITROGEN = 70
MODERATE_NITROGEN = 140

DROPPED_AFTER_BACKFILL = (
    *[schemas.slot_column(f, "rate", n) for f in schemas.EVENT_FAMILIES for n in schemas.EVENT_SLOT_NUMBERS],
    *[f"{f}_{what}" for f in schemas.EVENT_FAMILIES for what in ("amount", "daytoplanting")],
)
DROPPED_AT_END = ("crops", "crop_rotation_1", "crop_rotation_2")


def reset_zero_applications(df: DataFrame) -> DataFrame:
    """Where a nitrogen amount is zero its type, dates, slot amounts and applications are cleared."""
    edits = {}
    for amount, (kind, applications, family) in APPLICATIONS.items():
        none_given = F.col(amount) == 0

        def cleared(column, value):
            return F.when(none_given, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column))

        edits[kind] = cleared(kind, None)
        edits[applications] = cleared(applications, 0)
        for n in schemas.EVENT_SLOT_NUMBERS:
            day = schemas.slot_column(family, "daytoplanting", n)
            slot_amount = schemas.slot_column(family, "amount", n)
            edits[day] = cleared(day, None)
            edits[slot_amount] = cleared(slot_amount, 0)
    return df.withColumns(edits)


def carbon_to_dry_matter(df: DataFrame, column: str = RAW_YIELD) -> DataFrame:
    return df.withColumn(column, F.col(f"`{column}`") * F.lit(schemas.CARBON_TO_DRY_MATTER))


def reject_implausible(df: DataFrame, yield_column: str = RAW_YIELD) -> DataFrame:
    """Drop rows with a low yield or with more applications than the amount allows.

    A comparison with a missing value rejects nothing.
    """
    synth, organic = F.col("n_synthamount"), F.col("n_org_amount")
    synth_times, organic_times = F.col("n_synth_replication"), F.col("n_org_replication")
    reject = (
        (F.col(f"`{yield_column}`") < MIN_YIELD)
        | ((synth <= MODERATE_NITROGEN) & (synth_times > 2))
        | ((organic <= MODERATE_NITROGEN) & (organic_times > 2))
        | ((synth < LOW_NITROGEN) & (synth_times > 1))
        | (synth.between(LOW_NITROGEN, MODERATE_NITROGEN) & (synth_times > 2))
    )
    return df.where(~F.coalesce(reject, F.lit(False)))


def backfill_single_applications(df: DataFrame) -> DataFrame:
    """With one application, slot 1 takes the whole amount and the general day."""
    edits = {}
    for amount, (_, applications, family) in APPLICATIONS.items():
        once = F.col(applications) == 1
        for target, source in (
            (schemas.slot_column(family, "amount", 1), amount),
            (schemas.slot_column(family, "daytoplanting", 1), f"{family}_daytoplanting"),
        ):
            edits[target] = F.when(once, F.col(source)).otherwise(F.col(target))
    return df.withColumns(edits)


def clear_none_types(df: DataFrame) -> DataFrame:
    return df.withColumns({kind: null_if(F.col(kind), "none") for kind, _, _ in APPLICATIONS.values()})


def add_total_nitrogen(df: DataFrame) -> DataFrame:
    """Total nitrogen and the storage types of amounts and calendar days."""
    total = F.col("n_org_amount") + F.col("n_synthamount")
    return df.withColumns(
        {
            "total_nitrogen": total.cast("float"),
            "n_org_amount": F.col("n_org_amount").cast("float"),
            "n_synthamount": F.col("n_synthamount").cast("float"),
            "planting_dayofyear": F.col("planting_dayofyear").cast("bigint"),
            "harvest_dayofyear": F.col("harvest_dayofyear").cast("bigint"),
        }
    )


def clean_panel(df: DataFrame) -> DataFrame:
    """All cleaning steps; one projection and one filter, no shuffle."""
    return (
        df.transform(reset_zero_applications)
        .transform(carbon_to_dry_matter)
        .transform(reject_implausible)
        .transform(backfill_single_applications)
        .transform(clear_none_types)
        .transform(drop_strict, DROPPED_AFTER_BACKFILL)
        .withColumnsRenamed(schemas.OUTPUT_NAMES)
        .transform(add_total_nitrogen)
        .transform(drop_strict, DROPPED_AT_END)
    )


def rows_per_id_histogram(df: DataFrame) -> DataFrame:
    """How many ids have how many rows."""
    per_id = df.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("rows_per_id"))
    return per_id.groupBy("rows_per_id").agg(F.count(F.lit(1)).alias("ids"))
