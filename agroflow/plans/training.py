"""Multi-target boosted-tree training and grouped cross-validation on MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from agroflow import schemas
from agroflow.operators.boosting import LeafwiseModel, LeafwiseOptions, fit_leafwise
from agroflow.operators.folds import fold_sizes, group_folds, shuffled_folds
from agroflow.operators.metrics import METRICS, cv_summary, regression_metrics
from agroflow.operators.targets import TargetScaling, fit_scalings_by_fold, fit_target_scalings, transform_targets
from agroflow.plans.scoring import ColumnStats, FeaturePreparation, ScoringModel, column_stats, encode_texts, mark_codes, nominal_codes, text_columns
from agroflow.sources.run_log import append_runs, new_token, run_folder, run_records
from agroflow.sources.workspace import shared_folder, stage


@dataclass(frozen=True)
class BoostingPreset:
    family: str
    rounds: int
    depth: int
    step_size: float
    min_rows: int = 1
    row_share: float = 1.0
    column_share: str = "all"
    bins: int = 256
    nominal: bool = False
    #: Settings of the library's own learner, which then takes the place of MLlib's.
    leafwise: LeafwiseOptions | None = None


# Settings of the three model families; those of the first three are what MLlib's boosted trees have, too.
PRESETS = {
    "depthwise": BoostingPreset("depthwise", 10_000, 9, 0.013556, 48, 0.8, "0.6", 256),
    "leafwise": BoostingPreset("leafwise", 5_000, 8, 0.01, 20, 0.8, "0.8", 256, nominal=True),
    "lossguide": BoostingPreset("lossguide", 2_000, 6, 0.013556, bins=64, nominal=True),
    "depthwise_native": BoostingPreset("depthwise_native", 10_000, 9, 0.013556, 48, 0.8, "0.6", 256, leafwise=LeafwiseOptions(
        leaves=1 << 9, l1=0.151021, l2=11.097351, min_gain=1.074052)),
    "leafwise_native": BoostingPreset("leafwise_native", 5_000, 0, 0.01, 20, 0.8, "0.8", 256, nominal=True, leafwise=LeafwiseOptions(
        leaves=256, l1=0.0, l2=1.0)),
    "lossguide_native": BoostingPreset("lossguide_native", 2_000, 6, 0.013556, bins=64, nominal=True, leafwise=LeafwiseOptions(
        leaves=1 << 6, l2=3.0)),
}


# Fixed value: rounds without a better error before cross-validation stops.
PATIENCE = 200
#: Models fitted at once; each takes its own jobs to the scheduler.
FITS_AT_ONCE = 4
#: Bytes that MLlib's learner keeps of a row beside its bins of four bytes each: objects, counts, and predictions of three rounds.
KEPT_ROW_BYTES = 240


@dataclass(frozen=True)
class TrainingResult:
    models: dict
    scalings: dict[str, TargetScaling]
    predictions: DataFrame
    metrics: DataFrame
    #: What scores raw rows: by run name, with all that the rows go through.
    scorers: Mapping[str, ScoringModel] = field(default_factory=dict, kw_only=True)


@dataclass(frozen=True)
class CrossValidation(TrainingResult):
    summary: DataFrame
    sizes: DataFrame
    n_splits: int
    splitter: str


def regressor(
    preset: BoostingPreset,
    target: str,
    rounds: int | None = None,
    depth: int | None = None,
    seed: int = 42,
) -> GBTRegressor:
    """One target's learner."""
    return GBTRegressor(
        featuresCol="features",
        labelCol=f"{target}_t",
        predictionCol=f"{target}_pred_t",
        maxIter=rounds or preset.rounds,
        maxDepth=depth or preset.depth,
        stepSize=preset.step_size,
        minInstancesPerNode=preset.min_rows,
        subsamplingRate=preset.row_share,
        featureSubsetStrategy=preset.column_share,
        maxBins=preset.bins,
        seed=seed,
    )


def feature_columns(df: DataFrame, targets: Sequence[str] = schemas.TARGETS, drop: Sequence[str] = ("id",)) -> list[str]:
    return [c for c in df.columns if c not in {*targets, *drop}]


def _category_columns(df: DataFrame, columns: Sequence[str], texts: Sequence[str]) -> list[str]:
    """Encoded columns: text ones and, in a prepared table, the category columns that already hold codes."""
    coded = [c for c in (*schemas.LABEL_COLUMNS, *schemas.ORDINAL_COLUMNS) if c in columns and isinstance(df.schema[c].dataType, IntegerType)]
    return list(dict.fromkeys([*texts, *coded]))


def mark_nominal(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """Tell the learner which columns hold category codes: those with at most ``bins`` codes."""
    tops = ColumnStats.merged(list(column_stats(df, columns).values())).tops if columns else {}
    return mark_codes(df, nominal_codes(tops, bins))


def stopping_round(errors: DataFrame, patience: int, by: Sequence[str] = ()) -> DataFrame:
    """The best round of each error curve (``by``, round, error) and the round at which training would stop.

    Training stops at the first round that is ``patience`` rounds past the best so far; the best up to there
    counts, the earliest of equals. A curve that never stops has its last round as ``stopped_at``.
    """
    # A curve has as many rows as rounds.
    so_far = Window.partitionBy(*by).orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    best = errors.withColumn("best", F.min(F.struct("error", "round")).over(so_far))
    waits = best.withColumn("over", F.col("round") - F.col("best.round") >= patience)
    stop = waits.groupBy(*by).agg(
        F.coalesce(F.min(F.when(F.col("over"), F.col("round"))), F.max("round")).alias("stopped_at"),
        F.collect_list(F.struct("round", F.col("best.round").alias("best_round"))).alias("rounds"),
    )
    at_stop = F.filter("rounds", lambda r: r["round"] == F.col("stopped_at"))[0]
    return stop.select(*by, at_stop["best_round"].alias("best_round"), "stopped_at")


def first_trees(model: GBTRegressionModel, rounds: int, spark: SparkSession) -> GBTRegressionModel:
    """The model after its first ``rounds`` rounds: boosting adds trees one by one, so these are all it had by then."""
    java, context = model._java_obj, spark.sparkContext
    package, new_array = context._jvm.org.apache.spark.ml.regression, context._gateway.new_array
    trees, weights = new_array(package.DecisionTreeRegressionModel, rounds), new_array(context._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees(), java.treeWeights())):
        if i < rounds:
            trees[i], weights[i] = tree, weight
    cut = package.GBTRegressionModel(f"{model.uid}_{rounds}", trees, weights)
    cut.setFeaturesCol(model.getFeaturesCol())
    cut.setPredictionCol(model.getPredictionCol())
    return GBTRegressionModel(cut)


def fit_model(
    train: DataFrame,
    preset: BoostingPreset,
    target: str,
    rounds: int | None = None,
    depth: int | None = None,
    seed: int = 42,
    held_out: DataFrame | None = None,
    patience: int | None = None,
    nominal: Mapping[int, int] | None = None,
) -> GBTRegressionModel | LeafwiseModel:
    """One target's model; with ``patience``, that of the best round on the held-out rows.

    The library's own learner ends its fit when patience does. MLlib's fits all rounds; the error curve on the
    held-out rows then says how many of its trees count.
    """
    if preset.leafwise is not None:
        options = replace(
            preset.leafwise, rounds=rounds or preset.rounds, depth=depth or preset.depth or None, step_size=preset.step_size, seed=seed,
            min_rows=preset.min_rows, row_share=preset.row_share, bins=preset.bins, column_share=1.0 if preset.column_share == "all" else float(preset.column_share),
        )
        return fit_leafwise(train, f"{target}_t", options, held_out, patience, f"{target}_pred_t", nominal if preset.nominal else None)
    model = regressor(preset, target, rounds, depth, seed).fit(train)
    if not patience or held_out is None:
        return model
    curve = list(enumerate(model.evaluateEachIteration(held_out, "squared"), start=1))
    errors = train.sparkSession.createDataFrame(curve, "round int, error double")
    best = stopping_round(errors, patience).first()["best_round"]
    return model if best == len(curve) else first_trees(model, best, train.sparkSession)


def storage_memory(spark: SparkSession) -> int:
    """Bytes in which the executors can keep rows, in local mode the driver."""
    context = spark.sparkContext
    driver = context._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    found, total = context._jsc.sc().getExecutorMemoryStatus().iterator(), 0
    while found.hasNext():
        place = found.next()
        if place._1() != driver or context.master.startswith("local[") or context.master == "local":
            total += place._2()._1()
    return total


def fits_in_memory(memory: int, rows: int, width: int, at_once: int) -> int:
    """At most ``at_once`` fits, and no more than can keep their rows in memory together; one in any case."""
    return max(1, min(at_once, memory // max(1, rows * (4 * width + KEPT_ROW_BYTES))))


def fit_at_once(jobs: Mapping[object, Callable[[], object]], at_once: int = FITS_AT_ONCE) -> dict:
    """The jobs' results by their names, at most ``at_once`` of them running; they share no state but the session."""
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        running = {name: pool.submit(inheritable_thread_target(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


@dataclass(frozen=True)
class _Input:
    """Encoded rows with their transformed targets, written once for the many passes of training."""

    table: DataFrame
    dictionary: DataFrame | None
    nominal: dict[str, int]
    stats: dict[int, ColumnStats]


def _training_input(
    df: DataFrame, preset: BoostingPreset, columns: Sequence[str], scalings: Mapping[str, TargetScaling], keep: Sequence[str], by: str | None = None
) -> _Input:
    """``df`` is a stored table; its encoded rows are written, and one pass over them gives all statistics, by part."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    texts = text_columns(df, columns)
    encoded, dictionary = encode_texts(df, columns)
    wanted = dict.fromkeys([*keep, *scalings, *[f"{t}_t" for t in scalings], *columns])
    table = stage(transform_targets(encoded, scalings).select(*[f"`{c}`" for c in wanted]), "training-input").df
    stats = column_stats(table, columns, by)
    categories = _category_columns(table, columns, texts) if preset.nominal else []
    tops = ColumnStats.merged(list(stats.values())).tops
    return _Input(table, dictionary, nominal_codes({c: tops[c] for c in categories}, preset.bins), stats)


def _preparation(made: _Input, columns: Sequence[str], missing: str, preset: BoostingPreset, parts: Sequence[int] | None = None) -> FeaturePreparation:
    """How rows become vectors, from the statistics of the given parts; flags do not depend on the parts."""
    plain = [c for c in columns if c not in made.nominal]
    imputation = None
    if missing == "impute" and preset.leafwise is None:
        whole = ColumnStats.merged(list(made.stats.values()))
        chosen = ColumnStats.merged([s for p, s in made.stats.items() if parts is None or p in parts])
        imputation = chosen.imputation(plain, whole.gaps())
    return FeaturePreparation(tuple(columns), made.dictionary, made.nominal, imputation)


def train_multi_target(
    df: DataFrame,
    preset: str = "depthwise",
    targets: Sequence[str] = schemas.TARGETS,
    rounds: int | None = None,
    depth: int | None = None,
    seed: int = 42,
    missing: str = "impute",
    keep: Sequence[str] = ("id",),
    log_dir: str | None = None,
    experiment: str | None = None,
    at_once: int = FITS_AT_ONCE,
) -> TrainingResult:
    """One boosted-tree model per target, scored on its own training rows.

    For MLlib's learner a feature with missing values is filled with its mean and gets a flag beside it; the library's
    own learner finds a side for them. Text features are encoded; presets that know categories take codes as such. A
    target that cannot be scored on some row is an error. ``scorers`` of the result score raw rows; with ``log_dir``
    they are saved in the run's folder.
    """
    chosen = PRESETS[preset]
    keep = [c for c in keep if c in df.columns]
    columns = feature_columns(df, targets, ["id"])
    df = stage(df, "training-rows").df
    scalings = fit_target_scalings(df, targets)
    made = _training_input(df, chosen, columns, scalings, keep)
    preparation = _preparation(made, columns, missing, chosen)
    rows = stage(preparation.finish(made.table).select(*dict.fromkeys([*keep, *targets, *[f"{t}_t" for t in targets], "features"])), "training-vectors").df
    places = preparation.nominal_places()
    models = fit_at_once({t: lambda t=t: fit_model(rows, chosen, t, rounds, depth, seed, nominal=places) for t in targets}, at_once)
    scorer = ScoringModel(chosen.family, preparation, scalings, models)
    predictions = scorer.predictions(rows, keep, known=True).withColumn("model", F.lit(chosen.family))
    metrics = stage(regression_metrics(predictions, ["model", "target"]), "metrics").df
    _require_complete(metrics)
    scorers = {f"{chosen.family}_train_full": scorer}
    if log_dir:
        _log(metrics.withColumn("run_name", F.lit(f"{chosen.family}_train_full")), scorers, scalings,
             _parameters(chosen, rounds, depth, seed), chosen.family, log_dir, experiment or f"multi_target_{chosen.family}")
    return TrainingResult(models, scalings, predictions, metrics, scorers=scorers)


def cross_validate(
    df: DataFrame,
    preset: str = "depthwise",
    n_splits: int = 5,
    group: str | None = "id",
    targets: Sequence[str] = schemas.TARGETS,
    rounds: int | None = None,
    depth: int | None = None,
    seed: int = 42,
    patience: int | None = PATIENCE,
    missing: str = "impute",
    fit_scaling_on_train: bool = False,
    log_dir: str | None = None,
    experiment: str = "multi_target_cv",
    at_once: int = FITS_AT_ONCE,
) -> CrossValidation:
    """Train and score every target on every fold, ``at_once`` models at a time or as many as memory holds the rows of.

    Rows of a group share a fold; without the group column the folds are
    shuffled rows. Missing features are filled with means of the fold's training rows. Targets are scaled on all
    rows, or per fold on its training rows with ``fit_scaling_on_train``. Either way one pass gives the numbers of
    all folds: a training side is the other folds' statistics put together. A fold's model is that of its best
    round on the held-out rows once ``patience`` rounds brought nothing better.
    """
    chosen = PRESETS[preset]
    grouped = group is not None and group in df.columns
    columns = feature_columns(df, targets, [group] if grouped else [])
    df = stage(df, "training-rows").df
    if grouped:
        folded = group_folds(df, group, n_splits, seed)
        splitter = f"group folds (n_splits={n_splits}, group={group})"
    else:
        folded = shuffled_folds(df, df.columns, n_splits, seed)
        splitter = f"shuffled folds (n_splits={n_splits}, seed={seed})"
    keep = [group, "fold"] if grouped else ["fold"]
    folds = list(range(1, n_splits + 1))
    scalings = fit_target_scalings(df, targets)
    made = _training_input(folded, chosen, columns, scalings, keep, "fold")
    by_fold = fit_scalings_by_fold(made.table, targets, folds) if fit_scaling_on_train else dict.fromkeys(folds, scalings)

    scorers, jobs, tests, stored = {}, {}, {}, {}
    for fold in folds:
        held_out = F.col("fold") == fold
        preparation = _preparation(made, columns, missing, chosen, [f for f in folds if f != fold])
        # Vectors are written once for the many passes of the fits: once for all folds, if no mean and no scaling tells them apart.
        apart = (preparation.fills(), tuple(by_fold[fold].items()))
        if apart not in stored:
            rows = transform_targets(made.table, by_fold[fold]) if fit_scaling_on_train else made.table
            vectors = preparation.finish(rows, known=True).select(*keep, *targets, *[f"{t}_t" for t in targets], "features")
            stored[apart] = stage(vectors, "cv-vectors", "fold").df
        train, tests[fold] = stored[apart].where(~held_out), stored[apart].where(held_out)
        scorers[fold] = ScoringModel(chosen.family, preparation, by_fold[fold], {})
        places = preparation.nominal_places()
        jobs |= {
            (fold, t): lambda t=t, train=train, test=tests[fold], places=places: fit_model(train, chosen, t, rounds, depth, seed, test, patience, places)
            for t in targets
        }
    if chosen.leafwise is None:
        total = sum(s.rows for s in made.stats.values())
        largest = total - min((made.stats[f].rows if f in made.stats else 0) for f in folds)
        at_once = fits_in_memory(storage_memory(df.sparkSession), largest, max(len(s.preparation.names) for s in scorers.values()), at_once)
    fitted = fit_at_once(jobs, at_once)
    scorers = {fold: replace(s, models={t: fitted[fold, t] for t in targets}) for fold, s in scorers.items()}
    scored = [s.predictions(tests[fold], keep, known=True) for fold, s in scorers.items()]
    predictions = stage(reduce(DataFrame.unionByName, scored).withColumn("model", F.lit(chosen.family)), "cv-predictions").df
    metrics = stage(regression_metrics(predictions, ["model", "target", "fold"]), "cv-metrics").df
    _require_complete(metrics)
    named = {f"{chosen.family}_cv_fold{fold}": s for fold, s in scorers.items()}
    if log_dir:
        runs = metrics.withColumn("run_name", F.concat(F.lit(f"{chosen.family}_cv_fold"), "fold"))
        parameters = {**_parameters(chosen, rounds, depth, seed), "patience": patience, "n_splits": n_splits}
        _log(runs, named, scalings, parameters, chosen.family, log_dir, experiment)
    return CrossValidation(
        {name: dict(s.models) for name, s in named.items()}, scalings, predictions, metrics, cv_summary(metrics), fold_sizes(made.table),
        n_splits, splitter, scorers=named,
    )


def _require_complete(metrics: DataFrame) -> None:
    """Every row must have been scored; few rows, one for each model, target and fold."""
    gaps = {r["target"]: r["n_missing"] for r in metrics.where("n_missing > 0").collect()}
    if gaps:
        raise ValueError(f"rows without a target value or a prediction: {gaps}")


def _own_parameters(preset: BoostingPreset) -> dict[str, object]:
    """What only the library's own learner has."""
    own = preset.leafwise
    return {"leafwise": own is not None} if own is None else {"leafwise": True, "leaves": own.leaves, "l1": own.l1, "l2": own.l2, "min_gain": own.min_gain}


def _parameters(preset: BoostingPreset, rounds: int | None, depth: int | None, seed: int) -> dict[str, object]:
    return {**asdict(preset), "rounds": rounds or preset.rounds, "depth": depth or preset.depth, "seed": seed} | _own_parameters(preset)


def _log(metrics, scorers, scalings, parameters, family, log_dir, experiment) -> None:
    """Save every run's scorer in the run's own folder and append one record per run."""
    spark = metrics.sparkSession
    root = f"{log_dir.rstrip('/')}/{experiment}"
    token = new_token()
    first = next(iter(scorers.values()))
    kind = type(next(iter(first.models.values())))
    for run_name, scorer in scorers.items():
        scorer.save(run_folder(root, token, run_name), spark)
    names = first.preparation.names
    append_runs(run_records(metrics, family, names, root, scalings, f"{kind.__module__}.{kind.__name__}", parameters, token), experiment, log_dir)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions as Parquet, one folder per model, fold (if they have one) and target.

    Only the folders that ``predictions`` has rows for are replaced; those of other models stay.
    """
    folders = [c for c in ("model", "fold", "target") if c in predictions.columns]
    writer = predictions.select(*folders, "y", "y_pred").write.mode("overwrite").partitionBy(*folders)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_cv_summary(cv: CrossValidation, path: str) -> None:
    """One JSON record: splitter, fold sizes, and per target the fold metrics, their means and deviations.

    Its lists have one entry per fold, its map one per target.
    """
    per_fold = F.array_sort(F.collect_list(F.struct("fold", *METRICS)))
    folds = cv.metrics.groupBy("target").agg(per_fold.alias("fold_metrics"))

    def gathered(prefix: str):
        return F.struct(*[F.col(f"{prefix}_{m}").alias(m) for m in METRICS])

    result = F.struct("fold_metrics", gathered("mean").alias("mean_metrics"), gathered("std").alias("std_metrics"))
    results = folds.join(cv.summary, "target").agg(
        F.map_from_entries(F.collect_list(F.struct("target", result))).alias("cv_results"),
        F.array_sort(F.collect_list("target")).alias("targets"),
    )
    splits = [
        F.struct(*[F.lit(value).alias(name) for name, value in size.asDict().items()])
        for size in cv.sizes.orderBy("fold").collect()
    ]
    record = results.select(
        F.lit(cv.n_splits).alias("n_splits"),
        F.lit(cv.splitter).alias("splitter"),
        "targets",
        F.array(*splits).alias("splits_info"),
        "cv_results",
    )
    record.write.mode("overwrite").json(path)
