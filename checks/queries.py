"""One query per operator: (spark, folder) to a DataFrame with plain, aliased columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroflow import schemas
from agroflow.functions.measures import aridity_class, yeo_johnson
from agroflow.operators import boosting, cleaning, climate, encoding, events, features, folds, metrics, rows, targets
from agroflow.plans import preparation, report, scoring, training, training_table
from agroflow.sources import run_log, storage, tables
from agroflow.sources.workspace import fresh_path, stage
from checks.views import EDGE_YEARS, RAW_NAMES, Tables

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Queries whose results SQL cannot compute.
WITHOUT_SQL: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

PLAIN_NAMES = {raw: plain for plain, raw in RAW_NAMES.items()}
CODED = training_table.ENCODED
SLOT_DAYS = [schemas.offset_column(s) for s in schemas.EVENT_SLOTS]
SLOT_AMOUNTS = [schemas.slot_column(f, "amount", n) for f in schemas.EVENT_FAMILIES for n in schemas.EVENT_SLOT_NUMBERS]


def query(fn: Callable[[Tables], DataFrame], registry: dict = REGISTRY):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _comparable(fn(Tables(spark, folder)))

    registry[fn.__name__] = run
    return run


def query_without_sql(fn: Callable[[Tables], DataFrame]):
    return query(fn, WITHOUT_SQL)


def _comparable(df: DataFrame) -> DataFrame:
    """Dates as text and floats as doubles, the same in both engines."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            casts[f.name] = F.col(f"`{f.name}`").cast("string")
        elif isinstance(f.dataType, T.FloatType):
            casts[f.name] = F.col(f"`{f.name}`").cast("double")
    return df.withColumns(casts) if casts else df


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# --- sources ---------------------------------------------------------------


@query
def scan_climate_normalised(t: Tables) -> DataFrame:
    return t.climate.select("id", "date", "prec", "tavg")


@query
def scan_project_filter(t: Tables) -> DataFrame:
    wanted = (F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") == "F")
    orders = tables.read_parquet(t.spark, f"{t.folder}/orders.parquet", where=wanted)
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query
def sorted_limit(t: Tables) -> DataFrame:
    return rows.head(t.outputs.select("id", "year", "n_org_amount", "n_synthamount"), ["id", "year"], 1000)


@query
def csv_to_parquet_roundtrip(t: Tables) -> DataFrame:
    source, target = fresh_path(t.spark, "outputs-csv"), fresh_path(t.spark, "outputs-parquet")
    tables.write_csv(t.outputs, source)
    tables.csv_to_parquet(t.spark, source, target)
    return tables.read_parquet(t.spark, target).withColumnsRenamed(PLAIN_NAMES)


@query
def split_parquet_roundtrip(t: Tables) -> DataFrame:
    target = fresh_path(t.spark, "split")
    tables.write_parquet(t.outputs.select("id", "year", "soil", "n_org_amount"), target, max_records_per_file=1000)
    return tables.read_parquet(t.spark, target)


@query
def csv_climate_scan(t: Tables) -> DataFrame:
    """Daily climate as text, with identifiers that are no numbers."""
    source = fresh_path(t.spark, "climate-csv")
    tables.write_csv(t.climate.withColumn("id", F.concat(F.lit("A"), F.col("id"))), source)
    return tables.read_climate(t.spark, source, id_type="string").select("id", "date", "prec", "tavg")


@query
def csv_class_scan(t: Tables) -> DataFrame:
    source = fresh_path(t.spark, "classes-csv")
    tables.write_csv(t.classes.select("id", F.col("aridity_index").alias("Aridity index")), source)
    return tables.read_climate_classes(t.spark, source)


def _spoilt_climate(t: Tables) -> str:
    """Climate text in which some rain is no number and some temperatures are marked as missing."""
    path = fresh_path(t.spark, "climate-csv")
    rain = F.when(F.col("id") % 37 == 5, F.concat(F.lit("about "), F.col("id"))).otherwise(F.col("prec").cast("string"))
    tables.write_csv(t.climate.select("id", "date", rain.alias("prec"), F.when(F.col("id") % 41 == 7, "NA").otherwise(F.col("tavg").cast("string")).alias("tavg")), path)
    return path


@query
def csv_quarantine(t: Tables) -> DataFrame:
    """The rows that stay when malformed ones are tolerated."""
    kept = tables.read_csv(t.spark, _spoilt_climate(t), schemas.CLIMATE_TYPES, tolerate=0.9)
    return kept.select("id", "date", "prec", "tavg")


@query
def csv_rejected_rows(t: Tables) -> DataFrame:
    """The table that a refused read leaves behind."""
    try:
        tables.read_csv(t.spark, _spoilt_climate(t), schemas.CLIMATE_TYPES)
    except tables.MalformedValues as error:
        rejected = t.spark.read.parquet(error.rejected)
        fields = F.split("text", ",")
        return rejected.select(fields[0].cast("bigint").alias("id"), fields[1].alias("date"), fields[2].alias("prec"), "reason")
    return t.spark.createDataFrame([], "id bigint, date string, prec string, reason string")


@query
def multi_file_union(t: Tables) -> DataFrame:
    """Files of one table whose columns and types differ."""
    whole = t.outputs
    parts = (
        whole.where("id % 3 = 0").select("id", F.col("year").cast("smallint").alias("year"), "n_org_amount"),
        whole.where("id % 3 = 1").select(F.col("year").cast("bigint").alias("year"), "soil", "id"),
        whole.where("id % 3 = 2").select("id", "year", F.col("n_org_amount").cast("int").alias("n_org_amount"), "soil"),
    )
    paths = [fresh_path(t.spark, "part") for _ in parts]
    for part, path in zip(parts, paths):
        tables.write_parquet(part, path)
    return tables.read_parquet(t.spark, *paths).select("id", "year", "n_org_amount", "soil")


@query
def bucketed_join(t: Tables) -> DataFrame:
    """The panel and the simulations stored by id, joined where they lie."""
    token = run_log.new_token()
    sims = t.sims.select(F.col("event_id").alias("id"), "climate_id", "site_id")
    panel = storage.write_bucketed(t.outputs.select("id", "year", "soil"), f"panel_{token}", ["id"], 8)
    storage.write_bucketed(sims, f"sims_{token}", ["id"], 8)
    return storage.join_stored(panel, f"sims_{token}", ["id"]).select("id", "year", "soil", "climate_id", "site_id")


@query
def csv_inferred_types(t: Tables) -> DataFrame:
    """Columns that no declaration names keep the type of their values."""
    source, target = fresh_path(t.spark, "outputs-csv"), fresh_path(t.spark, "outputs-parquet")
    extra = t.outputs.select(
        "id", "year", "planting_dayofyear", (F.col("id") * 7 % 1000).alias("lot"), (F.col("id") % 8 / 4).alias("share"),
        F.date_add(F.lit("2001-01-31").cast("date"), (F.col("id") % 400).cast("int")).alias("seen_on"), (F.col("id") % 2 == 0).alias("even"),
        F.when(F.col("id") % 5 == 0, "x9").otherwise((F.col("id") % 5).cast("string")).alias("mixed"),
    )
    tables.write_csv(extra, source)
    tables.csv_to_parquet(t.spark, source, target)
    return tables.read_parquet(t.spark, target)


@query
def join_with_overlap(t: Tables) -> DataFrame:
    left = t.outputs.select("id", "year", "n_org_amount", "soil")
    right = t.outputs.select("id", "year", F.col("n_synthamount").alias("n_org_amount"), "climate")
    left, right = rows.suffix_overlap(left, right, ["id", "year"])
    return left.join(right, ["id", "year"])


@query
def calendar_parts(t: Tables) -> DataFrame:
    return climate.calendar_parts(t.climate.select("id", "date"))


# --- climate ---------------------------------------------------------------


@query
def prec_days(t: Tables) -> DataFrame:
    return climate.precipitation_days(t.climate)


@query
def seasonal_winter(t: Tables) -> DataFrame:
    return climate.season_totals(t.climate, "winter", EDGE_YEARS)


@query
def seasonal_spring(t: Tables) -> DataFrame:
    return climate.season_totals(t.climate, "spring", EDGE_YEARS)


@query
def rolling_precip(t: Tables) -> DataFrame:
    return climate.rolling_precipitation(t.climate)


@query
def range_classify(t: Tables) -> DataFrame:
    return t.classes.select("id", "aridity_index", aridity_class(F.col("aridity_index")).alias("class"))


def _class_features(t: Tables) -> DataFrame:
    return climate.join_classes(
        climate.season_totals(t.climate, "winter", EDGE_YEARS), climate.classify_cells(t.classes)
    )


@query
def climate_class_join(t: Tables) -> DataFrame:
    return _class_features(t).withColumnRenamed("Class", "class")


@query
def simulation_climate_left(t: Tables) -> DataFrame:
    features_by_cell = stage(_class_features(t), "climate-features")
    return climate.join_simulations(t.sims, features_by_cell).withColumnRenamed("Class", "class")


# --- cleaning --------------------------------------------------------------


@query
def zero_application_reset(t: Tables) -> DataFrame:
    reset = cleaning.reset_zero_applications(t.outputs)
    return reset.select(
        "id", "year", "n_org_amount", "n_synthamount", "n_org_type", "n_synth_type",
        "n_org_replication", "n_synth_replication", *SLOT_DAYS, *SLOT_AMOUNTS,
    )


@query
def unit_convert(t: Tables) -> DataFrame:
    converted = cleaning.carbon_to_dry_matter(t.outputs).withColumnsRenamed(schemas.OUTPUT_NAMES)
    return _rounded(converted.select("id", "year", F.col("yield").alias("yield_dm")), ["yield_dm"])


@query
def quality_filter(t: Tables) -> DataFrame:
    ready = t.outputs.transform(cleaning.reset_zero_applications).transform(cleaning.carbon_to_dry_matter)
    kept = cleaning.reject_implausible(ready)
    return kept.select("id", "year", "n_org_amount", "n_synthamount", "n_org_replication", "n_synth_replication")


@query
def single_application_backfill(t: Tables) -> DataFrame:
    filled = cleaning.backfill_single_applications(t.outputs)
    return filled.select(
        "id", "year", "manu_amount_1", "fert_amount_1", "manu_daytoplanting_1", "fert_daytoplanting_1"
    )


@query
def sentinel_to_null(t: Tables) -> DataFrame:
    return cleaning.clear_none_types(t.outputs).select("id", "year", "n_org_type", "n_synth_type")


@query
def derive_totals_cast(t: Tables) -> DataFrame:
    total = cleaning.add_total_nitrogen(t.outputs)
    return total.select(
        "id", "year", "n_org_amount", "n_synthamount", "total_nitrogen", "planting_dayofyear", "harvest_dayofyear"
    )


@query
def clean_panel(t: Tables) -> DataFrame:
    return _rounded(cleaning.clean_panel(t.outputs), ["yield"])


@query
def id_count_histogram(t: Tables) -> DataFrame:
    return cleaning.rows_per_id_histogram(cleaning.clean_panel(t.outputs))


# --- events ----------------------------------------------------------------


def _event_panel(t: Tables) -> DataFrame:
    cells = t.base("supplier").count()
    cell = (F.expr("id div 100") + F.col("id") % 100 * 31) % cells
    return events.add_event_dates(t.outputs.withColumn("climate_id", cell))


@query
def event_dates(t: Tables) -> DataFrame:
    return _event_panel(t).select("id", "year", *map(schemas.date_column, schemas.EVENT_SLOTS))


@query
def dedupe_keep_first(t: Tables) -> DataFrame:
    first = rows.first_per_key(t.outputs, ["id"], ["year"])
    return first.select("id", "year", "n_org_amount", "n_org_type", "soil", "planting_dayofyear")


@query
def event_window_precip(t: Tables) -> DataFrame:
    return events.event_precipitation(events.event_rows(_event_panel(t)), t.climate)


@query
def event_window_precip_by_cell_day(t: Tables) -> DataFrame:
    return events.event_precipitation(events.event_rows(_event_panel(t)), t.climate, method="cell_day")


@query
def event_window_precip_by_range(t: Tables) -> DataFrame:
    return events.event_precipitation(events.event_rows(_event_panel(t)), t.climate, method="range")


@query
def event_window_precip_by_year(t: Tables) -> DataFrame:
    key = ("id", "year")
    return events.event_precipitation(events.event_rows(_event_panel(t), key), t.climate, key)


@query
def event_window_precip_ties(t: Tables) -> DataFrame:
    """Several rows of one id and year: the dates decide."""
    together = _event_panel(t).withColumn("id", F.expr("id div 100")).withColumn("climate_id", F.col("id") % 7)
    return events.event_precipitation(events.event_rows(together), t.climate)


@query
def event_window_empty(t: Tables) -> DataFrame:
    elsewhere = t.climate.withColumn("id", -1 - F.col("id"))
    return events.event_precipitation(events.event_rows(_event_panel(t)), elsewhere)


@query
def event_features_joined(t: Tables) -> DataFrame:
    panel = _event_panel(t)
    sums = stage(events.event_precipitation(events.event_rows(panel), t.climate), "event-precipitation")
    return events.join_event_features(panel.select("id", "year", "climate_id"), sums)


# --- enrichment and features -----------------------------------------------


def _enriched(t: Tables) -> DataFrame:
    return preparation.prepare(t.outputs, t.climate, t.classes, t.sims, t.soil, "winter", EDGE_YEARS)


@query
def enrich_chain(t: Tables) -> DataFrame:
    return _rounded(_enriched(t), ["yield"]).withColumnsRenamed({"Class": "class", "JB_Classes": "jb_classes"})


@query
def null_fill_policy(t: Tables) -> DataFrame:
    filled = features.fill_types_and_targets(cleaning.clean_panel(t.outputs))
    return _rounded(filled.select("id", "year", "n_org_type", "n_synth_type", *schemas.TARGETS), ["yield"])


@query
def ensure_columns(t: Tables) -> DataFrame:
    some = t.outputs.select("id", "year", F.col("manu_amount_3").alias(schemas.EVENT_PRECIPITATION[0]))
    return features.fill_event_precipitation(some)


@query
def engineered_features(t: Tables) -> DataFrame:
    made = ["synth_org_ratio", "precipitation_clay_interaction", "precip_n_interaction"]
    return _rounded(features.add_engineered_features(_enriched(t)).select("id", "year", *made), made)


@query
def squared_features(t: Tables) -> DataFrame:
    squared = features.add_squares(cleaning.clean_panel(t.outputs))
    return squared.select(
        "id", "year", *schemas.SQUARED_COLUMNS, *[f"{c}_sq" for c in schemas.SQUARED_COLUMNS]
    )


def _training_table(t: Tables) -> DataFrame:
    # The climate is read for seasons, rain days, its row count and the event windows; the simulations are measured and joined.
    climate_days, sims = stage(t.climate, "climate").df, stage(t.sims, "simulations").df
    panel = stage(preparation.prepare(t.outputs, climate_days, t.classes, sims, t.soil, "winter", EDGE_YEARS), "panel").df
    return training_table.training_table(panel, climate_days).table


@query
def prepare_training(t: Tables) -> DataFrame:
    return _rounded(_training_table(t), ["yield", "synth_org_ratio"])


# --- encoding --------------------------------------------------------------


def _categories(t: Tables) -> DataFrame:
    return cleaning.clean_panel(t.outputs).select("id", "year", *CODED)


@query
def encode_dictionary(t: Tables) -> DataFrame:
    return encoding.category_dictionary(_categories(t), CODED).select("column", "code", "value")


@query
def encode_fit(t: Tables) -> DataFrame:
    return encoding.fit_encode(_categories(t), CODED)[0]


@query
def encode_apply(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "dictionary")
    encoding.write_dictionary(encoding.category_dictionary(_categories(t), CODED), path)
    return encoding.apply_encoding(_categories(t), encoding.read_dictionary(t.spark, path))


@query
def encode_unknown_detect(t: Tables) -> DataFrame:
    known = encoding.category_dictionary(_categories(t).where("year = 1996"), CODED)
    return encoding.unknown_categories(_categories(t), known)


# --- targets ---------------------------------------------------------------


def _targets(t: Tables) -> DataFrame:
    cleaned = features.fill_types_and_targets(cleaning.clean_panel(t.outputs))
    return cleaned.select("id", "year", *schemas.TARGETS)


FIXED_POWER = 0.7


@query
def target_transform_log1p(t: Tables) -> DataFrame:
    scalings = {x: targets.TargetScaling("log1p") for x in schemas.LOG_TARGETS}
    made = [f"{x}_t" for x in schemas.LOG_TARGETS]
    return _rounded(targets.transform_targets(_targets(t), scalings).select("id", "year", *made), made)


@query
def yeo_johnson_apply(t: Tables) -> DataFrame:
    y = yeo_johnson(F.col("soc"), F.lit(FIXED_POWER))
    return _targets(t).select("id", "year", F.round(y, 6).alias("soc_t"))


@query
def target_inverse(t: Tables) -> DataFrame:
    scalings = {x: targets.TargetScaling("log1p") for x in schemas.LOG_TARGETS}
    scalings["soc"] = targets.TargetScaling("yeo-johnson", FIXED_POWER, 2.0, 3.0)
    there = targets.transform_targets(_targets(t), scalings)
    back = {x: F.round(s.invert(F.col(f"{x}_t")), 5) for x, s in scalings.items()}
    return there.select("id", "year", *[v.alias(x) for x, v in back.items()])


@query
def yeo_johnson_fit(t: Tables) -> DataFrame:
    stored = stage(_targets(t).select("soc"), "targets").df
    fitted = targets.fit_yeo_johnson(stored, "soc")
    return stored.agg(F.count("soc").alias("n")).select(
        "n",
        F.round(F.lit(fitted.lam), 4).alias("lam"),
        F.round(F.lit(fitted.mean), 3).alias("mean"),
        F.round(F.lit(fitted.std), 3).alias("std"),
    )


# --- folds and metrics -----------------------------------------------------


@query
def group_kfold(t: Tables) -> DataFrame:
    folded = folds.group_folds(t.outputs.select("id", "year"))
    per_group = folded.groupBy("id").agg(F.min("fold").alias("fold"), F.countDistinct("fold").alias("folds"),
                                         F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("fold").agg(F.sum("n").alias("n_val"), F.max("folds").alias("folds_per_group"))


@query
def group_kfold_hash(t: Tables) -> DataFrame:
    folded = folds.hash_folds(t.outputs.select("id", "year"), ["id"])
    per_group = folded.groupBy("id").agg(F.countDistinct("fold").alias("folds"), F.count(F.lit(1)).alias("n"),
                                         F.min("fold").alias("low"), F.max("fold").alias("high"))
    return per_group.agg(F.sum("n").alias("n"), F.max("folds").alias("folds_per_group"),
                         F.min("low").alias("first_fold"), F.max("high").alias("last_fold"))


@query
def kfold(t: Tables) -> DataFrame:
    folded = folds.shuffled_folds(t.outputs.select("id", "year"), ["id", "year"])
    return folds.fold_sizes(folded)


@query
def kfold_duplicates(t: Tables) -> DataFrame:
    """Only three different keys, yet even folds."""
    return folds.fold_sizes(folds.shuffled_folds(t.outputs.select((F.col("id") % 3).alias("key")), ["key"]))


@query
def fold_sizes(t: Tables) -> DataFrame:
    return folds.fold_sizes(t.outputs.select("id", (F.col("id") % 5 + 1).cast("int").alias("fold")))


def _fold_metrics(t: Tables) -> DataFrame:
    return metrics.regression_metrics(t.predictions, ["target", "fold"])


@query
def regression_metrics(t: Tables) -> DataFrame:
    return _rounded(_fold_metrics(t), metrics.METRICS)


@query
def metrics_with_missing(t: Tables) -> DataFrame:
    some = t.predictions.withColumn("y_pred", F.when(F.col("y") % 7 != 0, F.col("y_pred")))
    some = some.withColumn("y", F.when(F.col("y") % 11 == 0, float("nan")).otherwise(F.col("y")))
    return _rounded(metrics.regression_metrics(some, ["target", "fold"]), metrics.METRICS)


@query
def stopping_rounds(t: Tables) -> DataFrame:
    """The patience rule over one error curve per supplier."""
    position = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))
    curves = t.base("lineitem").select("l_suppkey", position.alias("round"), F.col("l_quantity").cast("double").alias("error"))
    return training.stopping_round(curves, 9, ["l_suppkey"])


@query
def cv_summary(t: Tables) -> DataFrame:
    summary = metrics.cv_summary(_fold_metrics(t))
    return _rounded(summary, [c for c in summary.columns if c.startswith(("mean_", "std_"))])


@query
def cv_report(t: Tables) -> DataFrame:
    return _rounded(metrics.cv_report(_fold_metrics(t)), metrics.METRICS)


@query
def run_log_flatten(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "runs")
    named = _fold_metrics(t).withColumn("run_name", F.concat(F.lit("trees_cv_fold"), F.col("fold")))
    run_log.append_runs(run_log.run_records(named, "depthwise", ["a", "b"], path), "cv", path)
    flat = run_log.flatten_runs(run_log.read_runs(t.spark, path, "cv"))
    return _rounded(flat.select("target", "fold", "rmse", "mae", "r2"), metrics.METRICS)


@query
def cv_report_from_log(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "runs")
    named = _fold_metrics(t).withColumn("run_name", F.concat(F.lit("trees_cv_fold"), F.col("fold")))
    for _ in range(2):  # the report takes the newest run of each fold
        run_log.append_runs(run_log.run_records(named, "depthwise", ["a", "b"], path), "cv", path)
    return _rounded(report.report(t.spark, path, "cv"), metrics.METRICS)


@query
def run_log_compacted(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "runs")
    named = _fold_metrics(t).withColumn("run_name", F.concat(F.lit("trees_cv_fold"), F.col("fold")))
    for experiment in ("a", "b"):
        run_log.append_runs(run_log.run_records(named, "depthwise", ["a"], path), experiment, path)
    run_log.compact_runs(t.spark, path)
    flat = run_log.flatten_runs(run_log.read_runs(t.spark, path))
    return _rounded(flat.select("experiment_name", "target", "fold", "rmse", "mae", "r2"), metrics.METRICS)


@query
def cv_summary_file(t: Tables) -> DataFrame:
    path, per_fold = fresh_path(t.spark, "cv-summary"), stage(_fold_metrics(t), "fold-metrics").df
    sizes = folds.fold_sizes(t.predictions)
    cv = training.CrossValidation({}, {}, t.predictions, per_fold, metrics.cv_summary(per_fold), sizes, 5, "given folds")
    training.write_cv_summary(cv, path)
    one = f"struct<{', '.join(f'{m}: double' for m in metrics.METRICS)}>"
    result = f"struct<fold_metrics: array<struct<fold: int, rmse: double>>, mean_metrics: {one}, std_metrics: {one}>"
    saved = t.spark.read.schema(f"n_splits int, cv_results map<string, {result}>").json(path)
    flat = saved.select("n_splits", F.explode("cv_results").alias("target", "of"))
    means = [F.round(f"of.{part}_metrics.{m}", 6).alias(f"{part}_{m}") for part in ("mean", "std") for m in metrics.METRICS]
    return flat.select("n_splits", "target", F.size("of.fold_metrics").alias("n_folds"), *means)


@query
def run_log_parameters(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "runs")
    named = _fold_metrics(t).withColumn("run_name", F.concat(F.lit("trees_cv_fold"), F.col("fold")))
    records = run_log.run_records(named, "depthwise", ["a"], path, parameters={"depth": 4, "step_size": 0.5})
    run_log.append_runs(records, "cv", path)
    return run_log.parameter_rows(run_log.read_runs(t.spark, path)).select("run_name", "parameter", "value")


@query
def predictions_two_models(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "predictions")
    for model in ("first", "second"):
        training.write_predictions(t.predictions.withColumn("model", F.lit(model)), path)
    return t.spark.read.parquet(path).select("model", "fold", "target", "y", "y_pred")


@query
def predictions_table(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "predictions")
    training.write_predictions(t.predictions.withColumn("model", F.lit("depthwise_v1")), path)
    return t.spark.read.parquet(path).select("model", "target", "y", "y_pred")


# --- training --------------------------------------------------------------

# The queries' own rounds and depth; the presets have far more.
ROUNDS, DEPTH = 3, 4


def _training_rows(t: Tables) -> DataFrame:
    """The training table; seasons that have no day in the sparse test climate count as -1."""
    return stage(_training_table(t).fillna(-1.0), "training-table").df


@query
def assemble_features(t: Tables) -> DataFrame:
    table = _training_rows(t)
    columns = training.feature_columns(table)
    vectors = scoring.assemble_features(table, columns).withColumn("values", vector_to_array("features"))
    return vectors.select(
        "id", "year", F.size("values").alias("width"), F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 3)
        .alias("total"),
    )


def _scored(predictions: DataFrame, by: list[str]) -> DataFrame:
    finite = F.count_if(F.col("y_pred").isNotNull() & ~F.isnan("y_pred") & (F.abs("y_pred") < float("inf")))
    return predictions.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), finite.alias("n_finite"))


@query
def train_multi_target(t: Tables) -> DataFrame:
    """Rows scored by each target's model; the models see missing features."""
    table = stage(_training_table(t), "training-table").df
    return _scored(training.train_multi_target(table, rounds=ROUNDS, depth=DEPTH).predictions, ["target"])


@query
def cv_train(t: Tables) -> DataFrame:
    """Rows scored on each target's folds."""
    return _scored(training.cross_validate(_training_table(t), rounds=ROUNDS, depth=DEPTH).predictions, ["target", "fold"])


@query_without_sql
def train_metrics(t: Tables) -> DataFrame:
    """Metrics and tree counts of the library's own learner on each fold, ended by patience."""
    table = stage(_training_table(t), "training-table").df
    cv = training.cross_validate(table, "lossguide_native", rounds=4, depth=3, patience=1, targets=("no3", "soc"), n_splits=2)
    trees = [(run.rsplit("fold", 1)[1], target, model.getNumTrees) for run, fitted in cv.models.items() for target, model in fitted.items()]
    counted = t.spark.createDataFrame([(int(fold), target, n) for fold, target, n in trees], "fold int, target string, n_trees int")
    return _rounded(cv.metrics.join(F.broadcast(counted), ["fold", "target"]), metrics.METRICS).select("target", "fold", "n", "n_trees", *metrics.METRICS)


@query
def train_stump(t: Tables) -> DataFrame:
    """The two leaves of one split with penalties, where the signal lies in missing and in large values."""
    late = F.col("manu_daytoplanting_1").isNull() | (F.col("manu_daytoplanting_1") >= 10)
    features = ["manu_daytoplanting_1", "manu_amount_1", "n_org_amount"]
    rows = t.outputs.withColumnsRenamed(PLAIN_NAMES).select(*features, (F.col("no3_raw") + F.when(late, 100).otherwise(0)).alias("y"))
    rows = stage(scoring.assemble_features(rows, features, "keep").select("features", "y"), "stump-rows").df
    options = boosting.LeafwiseOptions(rounds=1, leaves=2, step_size=1.0, l1=5.0, l2=2.0, min_gain=1.0)
    scored = stage(boosting.fit_leafwise(rows, "y", options, prediction="y_pred").transform(rows).select("y", "y_pred"), "stump-scores").df
    leaves = scored.groupBy(F.round("y_pred", 6).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_y"))
    return _rounded(leaves, ["mean_y"])


@query
def score_saved_model(t: Tables) -> DataFrame:
    """Rows scored by a model read back from its run's folder: with gaps, unseen text and no targets."""
    site = F.when(F.col("id") % 3 == 0, "field").when(F.col("id") % 3 == 1, "meadow")
    table = stage(_training_table(t).withColumn("site", site), "training-table").df
    log, new = fresh_path(t.spark, "runs"), F.col("id") % 4 == 0
    fitted = training.train_multi_target(table.where(~new), "lossguide", rounds=ROUNDS, depth=DEPTH, log_dir=log)
    gap = F.col("id") % 8 == 0
    rows = table.where(new).drop(*schemas.TARGETS).withColumns({
        "site": F.when(gap, "orchard").otherwise(F.col("site")), "n_org_amount": F.when(gap, F.lit(None)).otherwise(F.col("n_org_amount")),
    })
    folder = run_log.read_runs(t.spark, log, latest=True).first()["artifacts_dir"]
    loaded = scoring.ScoringModel.load(folder, t.spark)
    key = ["id", "year", "target"]
    here = next(iter(fitted.scorers.values())).score(rows, key[:2], unseen="missing").withColumnRenamed("y_pred", "y_here")
    both = loaded.score(rows, key[:2], unseen="missing").join(here, key)
    finite = F.count_if(F.col("y_pred").isNotNull() & ~F.isnan("y_pred"))
    return both.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), finite.alias("n_finite"), F.count_if(F.abs(F.col("y_pred") - F.col("y_here")) > 1e-9).alias("n_differing")
    )
