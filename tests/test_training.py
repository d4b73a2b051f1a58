"""Training, cross-validation, run log and report on a small training table."""

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from agroflow.operators.metrics import cv_report
from agroflow.plans import report, scoring, training
from agroflow.sources.run_log import flatten_runs, metric_rows, parameter_rows, read_runs
from agroflow.sources.workspace import stage
from checks.queries import _training_rows
from checks.views import Tables

SIZE = dict(rounds=2, depth=3)


@pytest.fixture(scope="module")
def table(spark):
    return _training_rows(Tables(spark, "/root/testdata/sf0.001"))


def test_presets(spark):
    made = training.regressor(training.PRESETS["depthwise"], "soc", rounds=5)
    assert (made.getMaxDepth(), made.getMaxIter(), made.getStepSize()) == (9, 5, 0.013556)
    assert (made.getMinInstancesPerNode(), made.getFeatureSubsetStrategy(), made.getMaxBins()) == (48, "0.6", 256)
    assert training.regressor(training.PRESETS["leafwise"], "soc").getMaxIter() == 5000
    assert training.regressor(training.PRESETS["lossguide"], "soc").getMaxBins() == 64


def test_full_training_is_logged_and_reloads(spark, table, tmp_path):
    log = str(tmp_path)
    result = training.train_multi_target(table, "lossguide", log_dir=log, **SIZE)
    assert result.predictions.count() == 4 * table.count()
    assert result.predictions.where(F.col("y_pred").isNull() | F.isnan("y_pred")).count() == 0
    record = read_runs(spark, log, "multi_target_lossguide").first()
    assert record["transformers"]["soc"]["kind"] == "yeo-johnson"
    assert "id" not in record["feature_names"]
    model = GBTRegressionModel.load(record["models"]["soc"]["artifact_path"])
    assert model.getNumTrees == 2
    assert metric_rows(read_runs(spark, log)).where("metric = 'soc_rmse'").count() == 1
    training.write_predictions(result.predictions, f"{log}/predictions")
    assert spark.read.parquet(f"{log}/predictions").where("target = 'soc'").count() == table.count()


def test_boosting_beats_the_mean(spark):
    df = spark.range(400).select(
        "id", *[((F.col("id") % 20) * k).cast("double").alias(t) for k, t in enumerate(("n2o", "no3", "yield", "soc"), 1)],
        (F.col("id") % 20).cast("double").alias("signal"),
    )
    result = training.train_multi_target(df, "lossguide", rounds=3, depth=4)
    assert all(r["r2"] > 0 for r in result.metrics.collect())


def test_cross_validation(spark, table, tmp_path, same):
    log = str(tmp_path)
    cv = training.cross_validate(table, n_splits=2, log_dir=log, **SIZE)
    assert cv.predictions.count() == 4 * table.count()
    sizes = {r["fold"]: (r["n_train"], r["n_val"]) for r in cv.sizes.collect()}
    assert sum(v for _, v in sizes.values()) == table.count() and set(sizes) == {1, 2}
    assert cv.summary.count() == 4
    per_fold = cv.predictions.groupBy("id").agg(F.countDistinct("fold").alias("n"))
    assert per_fold.where("n > 1").count() == 0
    flat = flatten_runs(read_runs(spark, log, "multi_target_cv"))
    same(flat.select("target", "fold", "rmse"), cv.metrics.select("target", "fold", "rmse"))
    made = report.report(spark, log, "multi_target_cv")
    assert made.count() == 12
    same(made, cv_report(cv.metrics))
    report.write_report(spark, log, "multi_target_cv", f"{log}/report")
    assert spark.read.option("header", True).csv(f"{log}/report").columns == ["target", "fold", "rmse", "mae", "r2"]
    training.write_cv_summary(cv, f"{log}/summary")
    saved = spark.read.json(f"{log}/summary").first()
    assert saved["n_splits"] == 2 and len(saved["splits_info"]) == 2 and len(saved["cv_results"]["soc"]["fold_metrics"]) == 2


def test_patience_cuts_the_model(spark):
    # A signal that one tree of depth 1 learns: further rounds only fit noise of the training rows.
    df = spark.range(300).select(
        (F.col("id") % 30).alias("id"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 + 5 * (F.col("id") % 2)).alias("soc"),
        (F.col("id") % 2).cast("double").alias("signal"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)).cast("double").alias("noise"),
    )
    kwargs = dict(n_splits=2, targets=("soc",), rounds=12, depth=5)
    whole = training.cross_validate(df, "lossguide", patience=None, **kwargs)
    cut = training.cross_validate(df, "lossguide", patience=2, **kwargs)
    assert all(m["soc"].getNumTrees == 12 for m in whole.models.values())
    assert any(m["soc"].getNumTrees < 12 for m in cut.models.values())
    better = {r["fold"]: r["rmse"] for r in cut.metrics.collect()}
    assert all(better[r["fold"]] <= r["rmse"] + 1e-9 for r in whole.metrics.collect())


@pytest.mark.parametrize("errors, patience, best, stopped", [
    ([5, 4, 3, 3, 4, 2], 2, 3, 5), ([5, 4, 3, 3, 4, 2], 3, 6, 6), ([1], 5, 1, 1), ([1, 1, 1, 1, 0], 3, 1, 4), ([3, 2, 1], 1, 3, 3),
])
def test_stopping_round(spark, errors, patience, best, stopped):
    curve = spark.createDataFrame([("a", i, float(e)) for i, e in enumerate(errors, start=1)], "curve string, round int, error double")
    got = training.stopping_round(curve, patience, ["curve"]).first()
    assert (got["best_round"], got["stopped_at"]) == (best, stopped)


def test_missing_features_are_imputed_and_flagged(spark):
    rows = [(i, float(i % 7), None if i % 3 == 0 else float(i % 5), float("nan") if i % 4 == 0 else 1.0, None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, soc double, a double, b double, empty double")
    imputation = scoring.fit_imputation(df, ["a", "b", "empty"])
    known = [r[2] for r in rows if r[2] is not None]
    assert imputation.means == {"a": pytest.approx(sum(known) / len(known)), "b": 1.0, "empty": 0.0}
    filled = imputation.apply(df)
    assert filled.where("a is null or isnan(b) or empty is null").count() == 0
    assert filled.where("a_missing = 1").count() == 20 and filled.where("empty_missing = 1").count() == 60
    result = training.train_multi_target(df, "depthwise", targets=("soc",), rounds=1, depth=2)
    assert result.predictions.count() == 60


def test_category_codes_are_nominal(spark):
    df = spark.createDataFrame([(i, float(i % 4 % 2), i % 4 - 1, i * 37 % 90) for i in range(90)], "id int, soc double, soil int, climate int")
    marked = training.mark_nominal(df, ["soil", "climate"], 64)
    assert marked.schema["soil"].metadata["ml_attr"]["vals"] == ["-1", "0", "1", "2"]
    assert "ml_attr" not in marked.schema["climate"].metadata
    assert {r.soil for r in marked.select("soil").distinct().collect()} == {0.0, 1.0, 2.0, 3.0}
    fitted = training.train_multi_target(df, "lossguide", targets=("soc",), rounds=1, depth=3).models["soc"]
    assert fitted.trees[0].toDebugString.count(" in {") > 0


def test_two_runs_keep_their_models_and_parameters(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 9), float(i % 4)) for i in range(40)], "id int, soc double, a double")
    log = str(tmp_path)
    for rounds in (1, 3):
        training.train_multi_target(df, "lossguide", targets=("soc",), rounds=rounds, depth=2, log_dir=log)
    trees = {r["parameters"]["rounds"]: GBTRegressionModel.load(r["models"]["soc"]["artifact_path"]).getNumTrees for r in read_runs(spark, log).collect()}
    assert trees == {"1": 1, "3": 3}
    assert parameter_rows(read_runs(spark, log)).where("parameter = 'depth' and value = '2'").count() == 2


def test_predictions_of_other_models_stay(spark, tmp_path):
    made = spark.createDataFrame([("m1", 1, "soc", 1.0, 2.0), ("m1", 2, "soc", 1.0, 2.0)], "model string, fold int, target string, y double, y_pred double")
    path = str(tmp_path / "predictions")
    training.write_predictions(made, path)
    training.write_predictions(made.where("fold = 1").replace("m1", "m2"), path)
    assert {tuple(r) for r in spark.read.parquet(path).select("model", "fold").collect()} == {("m1", 1), ("m1", 2), ("m2", 1)}


def test_rows_that_cannot_be_scored_are_an_error(spark):
    metrics = spark.createDataFrame([("soc", 1)], "target string, n_missing long")
    with pytest.raises(ValueError, match="soc"):
        training._require_complete(metrics)


def test_folds_without_a_group_column(table):
    cv = training.cross_validate(
        table.drop("id"), n_splits=2, targets=("soc",), rounds=1, depth=2, fit_scaling_on_train=True
    )
    n = table.count()
    assert sorted(r["n_val"] for r in cv.sizes.collect()) == [n // 2, n - n // 2]


def test_text_features_are_encoded(spark):
    df = spark.createDataFrame([(i, float(i), "ab"[i % 2] if i % 5 else None) for i in range(40)], "id int, soc double, kind string")
    result = training.train_multi_target(df, "lossguide", targets=("soc",), rounds=1, depth=2)
    assert result.predictions.count() == 40


def test_missing_features_are_reported(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 3.0)], "id int, a double, b double")
    with pytest.raises(Exception, match="null|NaN|handleInvalid"):
        scoring.assemble_features(df, ["a", "b"]).collect()
    assert scoring.assemble_features(df, ["a", "b"], missing="keep").count() == 2


def _gappy(spark, gap):
    """40 rows of 20 ids with one feature that misses some values, or none."""
    rows = [(i % 20, float(i % 9 + 1), None if gap and i % 3 == 0 else float(i * i % 17), i % 5) for i in range(40)]
    return spark.createDataFrame(rows, "id int, no3 double, a double, b int")


@pytest.mark.parametrize("gap", [False, True])
def test_folds_read_stored_vectors(spark, plan_of, monkeypatch, gap):
    """No fit assembles vectors again, and none reads the other side's files."""
    sides, fit = [], training.fit_model

    def seen(train, *args):
        sides.append((train, args[5]))
        return fit(train, *args)

    monkeypatch.setattr(training, "fit_model", seen)
    df = _gappy(spark, gap)
    cv = training.cross_validate(df, "lossguide", n_splits=2, targets=("no3",), rounds=1, depth=2)
    assert len(sides) == 2
    for train, held_out in sides:
        for side in (train, held_out):
            plan = plan_of(side.select("features"))
            assert "UDF" not in plan and "coalesce" not in plan and "fold" in plan.split("PartitionFilters: [")[1].split("]")[0]
        files = [{r[0] for r in side.select(F.input_file_name()).collect()} for side in (train, held_out)]
        assert files[0] and files[1] and not files[0] & files[1]
        assert train.count() + held_out.count() == 40
        # A missing value has the mean of the training side and its flag.
        rows = {(r["id"], r["no3"]): list(r["features"].toArray()) for side in (train, held_out) for r in side.collect()}
        ids = {r["id"] for r in train.select("id").collect()}
        known = [r["a"] for r in df.collect() if r["id"] in ids and r["a"] is not None]
        for r in df.collect():
            filled = r["a"] if r["a"] is not None else pytest.approx(sum(known) / len(known))
            assert rows[r["id"], r["no3"]] == [filled, r["b"], *([float(r["a"] is None)] if gap else [])]
    # Without gaps all folds have the same vectors, which are written once.
    folders = {file.rsplit("/fold=", 1)[0] for train, _ in sides for file in train.inputFiles()}
    assert len(folders) == (2 if gap else 1)
    assert "UDF" not in plan_of(cv.predictions)


def test_rows_of_later_tables_are_filled_where_training_had_no_gap(spark):
    cv = training.cross_validate(_gappy(spark, False), "lossguide", n_splits=2, targets=("no3",), rounds=1, depth=2)
    scored = next(iter(cv.scorers.values())).score(_gappy(spark, True).drop("no3"))
    assert scored.where("y_pred is not null").count() == 40


def test_a_table_stored_in_parts_keeps_its_rows_and_columns(spark, same):
    df = spark.range(30).select((F.col("id") % 3).cast("int").alias("part"), F.col("id").cast("string").alias("text"), "id")
    stored = stage(df, "parts", "part")
    assert stored.rows == 30 and stored.df.columns == df.columns and stored.df.dtypes == df.dtypes
    same(stored.df, df)
    files = stored.df.select("part", F.input_file_name().alias("file")).groupBy("file").agg(F.countDistinct("part").alias("parts"))
    assert files.where("parts <> 1").count() == 0


def test_fits_run_at_once_as_far_as_memory_holds_their_rows(spark, monkeypatch):
    assert [training.fits_in_memory(m << 30, 1 << 20, 196, 4) for m in (0, 1, 2, 3, 99)] == [1, 1, 2, 3, 4]
    assert training.storage_memory(spark) > 1 << 28
    seen, run = [], training.fit_at_once
    monkeypatch.setattr(training, "storage_memory", lambda spark: 0)
    monkeypatch.setattr(training, "fit_at_once", lambda jobs, at_once: seen.append((len(jobs), at_once)) or run(jobs, at_once))
    training.cross_validate(_gappy(spark, False), "lossguide", n_splits=2, targets=("no3",), rounds=1, depth=2)
    assert seen == [(2, 1)]
