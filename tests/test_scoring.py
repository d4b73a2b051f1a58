"""Models that are read back and score raw rows; statistics of folds by complements; fits side by side."""

import math
import threading
import time
from dataclasses import replace

import pytest
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from agroflow.operators.boosting import LeafwiseModel
from agroflow.operators.targets import fit_scalings_by_fold, fit_target_scalings, fit_yeo_johnson
from agroflow.plans import scoring, training
from agroflow.sources.run_log import read_runs

TARGETS = ("soc", "no3")
SCHEMA = "id int, kind string, soil int, a double, b double, soc double, no3 double"


def rows(first, n):
    return [
        (i, "xyz"[i % 3] if i % 7 else None, i % 4 - 1, None if i % 5 == 0 else float(i % 11), float(i * 37 % 50), float(i % 11 + (i % 3) * 5), float(i % 13))
        for i in range(first, first + n)
    ]


@pytest.mark.parametrize("preset", ["depthwise", "lossguide", "leafwise_native"])
def test_saved_model_scores_raw_rows_like_the_one_in_memory(spark, tmp_path, preset):
    train = spark.createDataFrame(rows(0, 240), SCHEMA)
    fitted = training.train_multi_target(train, preset, targets=TARGETS, rounds=2, depth=3, log_dir=str(tmp_path))
    record = read_runs(spark, str(tmp_path)).first()
    loaded = scoring.ScoringModel.load(record["artifacts_dir"], spark.newSession())
    (scorer,) = fitted.scorers.values()
    assert record["feature_names"] == scorer.preparation.names == loaded.preparation.names
    vector = scorer.preparation.apply(train).first()["features"]
    assert len(vector) == len(record["feature_names"])
    # b has a gap only here; orchard was never seen; targets are not there.
    new = spark.createDataFrame([(1, "orchard", 9, 3.0, None), (2, None, None, None, 4.0), (3, "x", 1, 2.0, 8.0)], "id int, kind string, soil int, a double, b double")
    here, there = (sorted(map(tuple, s.score(new, unseen="missing").collect())) for s in (scorer, loaded))
    assert here == there and len(here) == 6 and all(r[2] is not None and math.isfinite(r[2]) for r in here)
    with pytest.raises(ValueError, match="orchard"):
        loaded.score(new)
    known, made = (sorted((r.id, r.target, round(r.y_pred, 9)) for r in df.collect()) for df in (loaded.score(train), fitted.predictions))
    assert known == made
    kind = LeafwiseModel if preset.endswith("native") else GBTRegressionModel
    assert all(isinstance(m, kind) for m in loaded.models.values())


def test_a_missing_column_is_an_error(spark):
    fitted = training.train_multi_target(spark.createDataFrame(rows(0, 60), SCHEMA), targets=("soc",), rounds=1, depth=2)
    (scorer,) = fitted.scorers.values()
    with pytest.raises(ValueError, match="b"):
        scorer.score(spark.createDataFrame(rows(0, 3), SCHEMA).drop("b"))


def test_statistics_of_all_folds_in_one_pass_equal_refitting(spark):
    df = spark.createDataFrame([(i % 4 + 1, None if i % 6 == 0 else float(i * i % 17), float("nan") if i % 4 == 1 else i / 3.0) for i in range(200)], "fold int, a double, b double")
    parts = scoring.column_stats(df, ["a", "b"], "fold")
    for fold in range(1, 5):
        side = scoring.ColumnStats.merged([s for f, s in parts.items() if f != fold])
        again = scoring.ColumnStats.merged(list(scoring.column_stats(df.where(F.col("fold") != fold), ["a", "b"]).values()))
        assert (side.rows, side.counts, side.tops) == (again.rows, again.counts, again.tops)
        assert side.means == pytest.approx(again.means)
    # Fold 2 has no b at all.
    assert parts[2].counts["b"] == 0


def jobs_of(spark, run):
    """The run's result and the number of jobs it started."""
    group = f"counted-{time.time()}"
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    return out, found


def test_powers_of_all_folds_equal_refitting_and_need_no_more_passes(spark):
    df = spark.createDataFrame([(i % 5 + 1, math.exp(i % 37 / 9.0) - 3 + (i % 5) * 0.1) for i in range(1000)], "fold int, soc double").cache()
    together, passes = jobs_of(spark, lambda: fit_scalings_by_fold(df, ("soc",), range(1, 6)))
    _, single = jobs_of(spark, lambda: fit_yeo_johnson(df, "soc"))
    assert passes <= 1.5 * single
    for fold in range(1, 6):
        alone = fit_target_scalings(df.where(F.col("fold") != fold), ("soc",))["soc"]
        mine = together[fold]["soc"]
        assert (mine.lam, mine.mean, mine.std) == pytest.approx((alone.lam, alone.mean, alone.std), rel=1e-6)


def test_means_of_a_fold_come_from_its_training_rows(spark):
    df = spark.createDataFrame([(i, float(i % 9), None if i % 2 else 100.0 * (i % 10)) for i in range(60)], "id int, soc double, a double")
    cv = training.cross_validate(df, n_splits=3, targets=("soc",), rounds=1, depth=2, fit_scaling_on_train=True)
    means = {}
    for run, scorer in cv.scorers.items():
        held = {r["id"] for r in cv.predictions.where(F.col("fold") == int(run[-1])).collect()}
        train = [100.0 * (i % 10) for i in range(0, 60, 2) if i not in held]
        means[run] = scorer.preparation.imputation.means["a"]
        assert means[run] == pytest.approx(sum(train) / len(train))
        assert scorer.preparation.names == ["a", "a_missing"]
    assert len(set(means.values())) > 1


def test_the_first_trees_are_the_model_of_fewer_rounds(spark, tmp_path):
    df = scoring.assemble_features(spark.range(200).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 7 % 23).cast("double").alias("y")), ["a"])
    learner = GBTRegressor(labelCol="y", featuresCol="features", predictionCol="p", maxDepth=3, subsamplingRate=0.7, seed=5)
    cut, short = training.first_trees(learner.setMaxIter(6).fit(df), 2, spark), learner.setMaxIter(2).fit(df)
    cut.save(str(tmp_path / "m"))
    for model in (cut, GBTRegressionModel.load(str(tmp_path / "m"))):
        assert model.getNumTrees == 2
        assert [r.p for r in model.transform(df).collect()] == [r.p for r in short.transform(df).collect()]


def test_patience_fits_each_model_once(spark, monkeypatch):
    df = spark.createDataFrame([(i % 20, float(i % 2), float(i * 37 % 11), float(i * 7919 % 101)) for i in range(200)], "id int, s double, soc double, noise double")
    fits, whole = [], training.regressor
    monkeypatch.setattr(training, "regressor", lambda *a: fits.append(a[1]) or whole(*a))
    cv = training.cross_validate(df, "lossguide", n_splits=2, targets=("soc",), rounds=8, depth=4, patience=1)
    assert len(fits) == 2 and any(m["soc"].getNumTrees < 8 for m in cv.models.values())


def test_fits_run_side_by_side_and_change_nothing(spark):
    running, most, lock = set(), [0], threading.Lock()

    def job(i):
        with lock:
            running.add(i)
            most[0] = max(most[0], len(running))
        time.sleep(0.2)
        with lock:
            running.remove(i)
        return i * i

    assert training.fit_at_once({i: lambda i=i: job(i) for i in range(6)}, 3) == {i: i * i for i in range(6)}
    assert 2 <= most[0] <= 3
    with pytest.raises(ZeroDivisionError):
        training.fit_at_once({1: lambda: 1 / 0})
    df = spark.createDataFrame(rows(0, 120), SCHEMA)
    one, many = (training.cross_validate(df, n_splits=2, targets=TARGETS, rounds=2, depth=2, at_once=n).metrics.orderBy("target", "fold").collect() for n in (1, 4))
    assert one == many


def test_patience_of_the_own_learner_acts_in_cross_validation(spark, monkeypatch):
    monkeypatch.setitem(training.PRESETS, "quick", replace(training.PRESETS["lossguide_native"], step_size=0.9))
    df = spark.createDataFrame([(i % 30, float(i % 2), float(i % 2) * 5 + i * 7919 % 101 / 100, float(i * 37 % 97)) for i in range(300)], "id int, signal double, soc double, noise double")
    cv = training.cross_validate(df, "quick", n_splits=2, targets=("soc",), rounds=40, depth=2, patience=1, group="id")
    assert all(m["soc"].getNumTrees < 40 for m in cv.models.values())
