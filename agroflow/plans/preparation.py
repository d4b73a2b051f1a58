"""Raw files to the joined panel, and on to the training table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from agroflow import schemas
from agroflow.functions.calendar import crop_calendar
from agroflow.operators.cleaning import clean_panel
from agroflow.operators.climate import (
    INCOMPLETE_YEARS,
    classify_cells,
    join_classes,
    join_simulations,
    precipitation_days,
    season_totals,
)
from agroflow.operators.encoding import write_dictionary
from agroflow.operators.enrichment import cell_years, enrich
from agroflow.plans.training_table import training_table
from agroflow.sources import tables
from agroflow.sources.workspace import stage


FILE_NAMES = {
    # inputs
    "climate": "climate_daily.csv",
    "classes": "climate_classes.csv",
    "soil": "soil.parquet",
    "sims": "simulations_{crop}.parquet",
    "outputs_csv": "outputs_{crop}.csv",
    "outputs": "outputs_{crop}.parquet",
    # stage tables
    "cleaned": "outputs_{crop}_cleaned.parquet",
    "prec_days": "precipitation_days.csv",
    "sims_climate": "simulations_{crop}_climate.parquet",
    "panel": "panel_{crop}.parquet",
    "prec_events": "event_precipitation_{crop}.parquet",
    "dictionary": "categories_{crop}.json",
    "training": "training_{crop}.parquet",
}


@dataclass(frozen=True)
class DataFolder:
    """Where the files of one crop lie; ``names`` replaces file names that differ from the usual ones."""

    root: str
    crop: str
    names: Mapping[str, str] = field(default_factory=dict)

    def path(self, what: str) -> str:
        name = {**FILE_NAMES, **self.names}[what]
        return f"{self.root.rstrip('/')}/{name.format(crop=self.crop)}"


def prepare(
    outputs: DataFrame,
    climate: DataFrame,
    classes: DataFrame,
    sims: DataFrame,
    soil: DataFrame,
    crop_type: str,
    incomplete_years=INCOMPLETE_YEARS,
) -> DataFrame:
    """The joined panel from its five inputs, without intermediate files.

    Only the cell-year table, an aggregate of the climate, is staged.
    """
    crop_calendar(crop_type)
    features = join_classes(season_totals(climate, crop_type, incomplete_years), classify_cells(classes))
    cell_year = stage(cell_years(features, precipitation_days(climate)), "cell-years")
    return enrich(clean_panel(outputs), sims, cell_year, soil)


def _stored_climate(spark: SparkSession, folder: DataFolder) -> DataFrame:
    """The climate file parsed once; it is read several times, each time for few columns."""
    return stage(tables.read_climate(spark, folder.path("climate")), "climate").df


def run_preparation(
    spark: SparkSession,
    folder: DataFolder,
    crop_type: str,
    parquet: bool = True,
    incomplete_years=INCOMPLETE_YEARS,
) -> DataFrame:
    """Run all preparation stages over a data folder and leave each stage's table in it."""
    crop_calendar(crop_type)
    if not parquet:
        tables.csv_to_parquet(spark, folder.path("outputs_csv"), folder.path("outputs"), schemas.OUTPUT_TYPES)
    tables.write_parquet(clean_panel(tables.read_parquet(spark, folder.path("outputs"))), folder.path("cleaned"))

    climate = _stored_climate(spark, folder)
    tables.write_csv(precipitation_days(climate), folder.path("prec_days"))

    classes = classify_cells(tables.read_climate_classes(spark, folder.path("classes")))
    features = stage(join_classes(season_totals(climate, crop_type, incomplete_years), classes), "climate-features").df
    sims = tables.read_parquet(spark, folder.path("sims"))
    tables.write_parquet(join_simulations(sims, features), folder.path("sims_climate"))

    prec_days = tables.read_prec_days(spark, folder.path("prec_days"))
    panel = enrich(
        tables.read_parquet(spark, folder.path("cleaned")),
        sims,
        stage(cell_years(features, prec_days), "cell-years"),
        tables.read_parquet(spark, folder.path("soil")),
    )
    tables.write_parquet(panel, folder.path("panel"))
    return tables.read_parquet(spark, folder.path("panel"))


def run_training_table(spark: SparkSession, folder: DataFolder, **options) -> DataFrame:
    """Build the training table of a prepared data folder and write it with its dictionary."""
    panel = tables.read_parquet(spark, folder.path("panel"))
    built = training_table(panel, _stored_climate(spark, folder), **options)
    tables.write_parquet(built.event_precipitation, folder.path("prec_events"))
    write_dictionary(built.dictionary, folder.path("dictionary"))
    tables.write_parquet(built.table, folder.path("training"))
    return tables.read_parquet(spark, folder.path("training"))
