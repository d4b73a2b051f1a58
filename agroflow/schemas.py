"""Column roles, fixed names and source types shared by the whole package."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Names and lists that define the data model.

TARGETS = ("n2o", "no3", "yield", "soc")
LOG_TARGETS = ("n2o", "no3", "yield")

LABEL_COLUMNS = (
    "soil",
    "climate",
    "cropping_systems",
    "crop_rotation",
    "n_synth_type",
    "n_org_type",
    "n_org_replication",
    "n_synth_replication",
    "irrigation",
    "manu_depth",
)
ORDINAL_COLUMNS = ("n_org_amount", "n_synthamount")

# Raw simulator output names and the short names used after cleaning.
OUTPUT_NAMES = {
    "dN_n2o_emis[kgNha-1]": "n2o",
    "dN_no3_leach[kgNha-1]": "no3",
    "aC_harvest_export[kgCha-1]": "yield",
    "C_pool_change[kgCha-1]": "soc",
}

# Dry matter per unit of carbon.
CARBON_TO_DRY_MATTER = 1 / 0.45

NO_APPLICATION = "No Application"

UNUSED_AFTER_PREPARATION = (
    "planting_dayofyear",
    "harvest_dayofyear",
    "manu_daytoplanting_1",
    "manu_daytoplanting_2",
    "manu_daytoplanting_3",
    "fert_daytoplanting_1",
    "fert_daytoplanting_2",
    "fert_daytoplanting_3",
    "setup_id",
    "climate_id",
    "event_id",
    "site_id",
    "Class",
    "harvest_year",
    "JB_Classes",
    "manu_date_1",
    "manu_date_2",
    "manu_date_3",
    "fert_date_1",
    "fert_date_2",
    "fert_date_3",
)

# Columns whose squares become features.
SQUARED_COLUMNS = (
    "fert_amount_1",
    "fert_amount_2",
    "fert_amount_3",
    "manu_amount_1",
    "manu_amount_2",
    "manu_amount_3",
    "total_nitrogen",
)

# Event families and the slots each has.
EVENT_FAMILIES = ("manu", "fert")
EVENT_SLOT_NUMBERS = (1, 2, 3)

# Day windows around an event: label, first and last day relative to it,
# both ends included.
EVENT_WINDOWS = (
    ("total_precipitation_7_before", -7, 0),
    ("total_precipitation_3_after", 0, 3),
)
# ---------------------------------------------------------------------------

# Columns that tell the rows of a panel apart, even those of one id and year.
ROW_IDENTITY = ("id", "year", *TARGETS)

EVENT_SLOTS = tuple(f"{family}_{n}" for n in EVENT_SLOT_NUMBERS for family in EVENT_FAMILIES)


def slot_column(family: str, what: str, slot: int) -> str:
    return f"{family}_{what}_{slot}"


def date_column(slot: str) -> str:
    family, number = slot.split("_")
    return slot_column(family, "date", int(number))


def offset_column(slot: str) -> str:
    family, number = slot.split("_")
    return slot_column(family, "daytoplanting", int(number))


def window_column(label: str, slot: str) -> str:
    return f"{label}_{slot}"


EVENT_PRECIPITATION = tuple(
    window_column(label, slot) for slot in EVENT_SLOTS for label, _, _ in EVENT_WINDOWS
)

# Types of the text sources, by header name.
CLIMATE_TYPES = {"id": "bigint", "date": "date", "tavg": "double", "prec": "double"}
CLASS_TYPES = {
    "id": "bigint",
    "latitude": "double",
    "longitude": "double",
    "temperature average": "double",
    "annual precipitation": "double",
    "Aridity index": "double",
}
PREC_DAYS_TYPES = {"climate_id": "bigint", "year": "int", "prec_days": "bigint"}


def _output_types() -> dict[str, str]:
    types = {"id": "bigint", "year": "int"}
    for name in ("n_org_amount", "n_synthamount", *OUTPUT_NAMES, "manu_depth"):
        types[name] = "double"
    for name in ("n_org_replication", "n_synth_replication"):
        types[name] = "int"
    for name in ("planting_dayofyear", "harvest_dayofyear"):
        types[name] = "bigint"
    for family in EVENT_FAMILIES:
        for what in ("daytoplanting", "amount"):
            types[f"{family}_{what}"] = "double"
        for what in ("daytoplanting", "amount", "rate"):
            for slot in EVENT_SLOT_NUMBERS:
                types[slot_column(family, what, slot)] = "double"
    return types


OUTPUT_TYPES = _output_types()

# Names of a run record's fields.
METRIC_STRUCT = "struct<rmse: double, mae: double, r2: double>"
RUN_LOG_SCHEMA = (
    "run_id string, timestamp string, run_name string, model_family_name string, "
    "feature_names array<string>, "
    "models map<string, struct<artifact_path: string, class: string>>, "
    "transformers map<string, struct<kind: string, lambda: double, mean: double, std: double>>, "
    f"metrics map<string, {METRIC_STRUCT}>, artifacts_dir string, experiment_name string, "
    "parameters map<string, string>"
)
