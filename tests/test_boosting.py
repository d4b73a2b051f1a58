"""Leaf-wise boosting against a direct computation on arrays."""

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from agroflow.operators import boosting
from agroflow.operators.boosting import Binning, LeafwiseModel, LeafwiseOptions, fit_leafwise
from agroflow.plans.scoring import assemble_features


def frame(spark, x, y):
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    names = [f"c{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double")
    return assemble_features(df, names, "keep")


def score(g, n, o):
    return max(abs(g) - o.l1, 0.0) ** 2 / (n + o.l2)


def direct_splits(bins, g, rows, o):
    """Every allowed split of the rows as (gain, feature, bins that go left)."""
    for j in range(bins.shape[1]):
        present = sorted(set(bins[rows, j]) - {0})
        for k in range(len(present)):
            for missing in (set(), {0}):
                if missing and not (bins[rows, j] == 0).any():
                    continue
                to_left = np.isin(bins[rows, j], list(set(present[: k + 1]) | missing))
                n, m = to_left.sum(), (~to_left).sum()
                if n < o.min_rows or m < o.min_rows:
                    continue
                left, right = g[rows][to_left].sum(), g[rows][~to_left].sum()
                gain = score(left, n, o) + score(right, m, o) - score(left + right, n + m, o)
                if gain > o.min_gain:
                    yield gain, j, rows[to_left], rows[~to_left]


def direct_predictions(bins, y, o):
    """Best-first trees, one split at a time."""
    f = np.full(len(y), y.mean())
    for _ in range(o.rounds):
        g = f - y
        leaves = [(np.arange(len(y)), 0)]
        while len(leaves) < o.leaves:
            options = [(s, i) for i, (rows, depth) in enumerate(leaves) if o.depth is None or depth < o.depth for s in direct_splits(bins, g, rows, o)]
            if not options:
                break
            (_, _, left, right), i = max(options, key=lambda x: (round(x[0][0], 9), -x[0][1]))
            depth = leaves.pop(i)[1] + 1
            leaves += [(left, depth), (right, depth)]
        for rows, _ in leaves:
            t = g[rows].sum()
            f[rows] -= o.step_size * np.sign(t) * max(abs(t) - o.l1, 0) / (len(rows) + o.l2)
    return f


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=n), rng.integers(0, 6, n).astype(float), rng.random(n)]
    y = np.where(x[:, 0] > 0.3, 4.0, 0) + x[:, 1] ** 2 + rng.normal(size=n)
    gone = rng.random(n) < 0.2
    x[gone, 2] = np.nan
    return x, y + 3 * gone


@pytest.mark.parametrize("options", [
    LeafwiseOptions(rounds=3, leaves=6, step_size=0.5, l1=2.0, l2=3.0, min_rows=5, min_gain=1.0, bins=16),
    LeafwiseOptions(rounds=1, leaves=100, depth=3, step_size=1.0, l2=0.0, min_rows=10, bins=8),
])
def test_equals_best_first_growth_on_arrays(spark, options):
    x, y = data()
    df = frame(spark, x, y)
    model = fit_leafwise(df.repartition(5), "y", options)
    wanted = direct_predictions(model.binning.bins(x), y, options)
    got = np.array([r["prediction"] for r in model.transform(df).collect()])
    assert np.allclose(got, wanted, atol=1e-6)
    assert all((t.feature < 0).sum() <= options.leaves for t in model.trees)


def test_partitions_do_not_change_the_trees(spark):
    x, y = data(600, 8)
    options = LeafwiseOptions(rounds=2, leaves=6, row_share=0.7, column_share=0.67, min_rows=4)
    models = [fit_leafwise(frame(spark, x, y).repartition(n), "y", options) for n in (1, 7)]
    for a, b in zip(models[0].trees, models[1].trees):
        assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("feature", "left", "right", "value", "goes_left"))


def test_missing_values_take_the_better_side(spark):
    """The signal is the missingness itself, and it is on the side of large values."""
    x = np.array([[np.nan if i % 3 == 0 else i % 7] for i in range(210)])
    y = np.where(np.isnan(x[:, 0]) | (x[:, 0] >= 5), 10.0, 0.0)
    model = fit_leafwise(frame(spark, x, y), "y", LeafwiseOptions(rounds=1, leaves=2, step_size=1.0, l2=0.0))
    assert np.allclose([r["prediction"] for r in model.transform(frame(spark, x, y)).collect()], y)
    filled = frame(spark, np.c_[np.where(np.isnan(x), np.nanmean(x), x), np.isnan(x)], y)
    stump = DecisionTreeRegressor(labelCol="y", maxDepth=1).fit(filled).transform(filled)
    assert stump.agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0] > 1


def test_categories_are_split_as_sets(spark):
    codes = np.array([[i % 6] for i in range(300)], float)
    y = np.isin(codes[:, 0], [0, 3, 4]).astype(float)
    options = LeafwiseOptions(rounds=1, leaves=2, step_size=1.0, l2=0.0)
    model = fit_leafwise(frame(spark, codes, y), "y", options, nominal={0: 6})
    assert np.allclose([r["prediction"] for r in model.transform(frame(spark, codes, y)).collect()], y)
    unseen = frame(spark, np.array([[9.0], [-1.0], [np.nan]]), np.zeros(3))
    assert len({r["prediction"] for r in model.transform(unseen).collect()}) == 1


def test_patience_ends_the_fit_early(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.random((300, 3))
    y = (x[:, 0] > 0.5) * 1.0 + rng.normal(size=300) * 0.5
    train, held = frame(spark, x[:200], y[:200]), frame(spark, x[200:], y[200:])
    options = LeafwiseOptions(rounds=200, leaves=4, step_size=0.6, l2=0.0)
    grown = []
    grow = boosting._grow
    monkeypatch.setattr(boosting, "_grow", lambda *a: grown.append(1) or grow(*a))
    model = fit_leafwise(train, "y", options, held, patience=2)
    assert len(grown) <= len(model.trees) + 2 * 2 < 60
    whole = fit_leafwise(train, "y", LeafwiseOptions(**{**options.__dict__, "rounds": len(model.trees)}))
    assert all(np.array_equal(a.value, b.value) for a, b in zip(model.trees, whole.trees))
    assert model.errors[len(model.trees) - 1] == min(model.errors[: len(model.trees) + 2])


def test_long_fits_are_stored_in_portions(spark, monkeypatch):
    x, y = data(200, 4)
    options = LeafwiseOptions(rounds=3, leaves=4, step_size=0.3)
    whole = fit_leafwise(frame(spark, x, y), "y", options)
    monkeypatch.setattr(boosting, "PORTION", 2)
    monkeypatch.setattr(boosting, "PASS_CELLS", 256 * 3)
    cut = fit_leafwise(frame(spark, x, y), "y", options)
    assert all(np.allclose(a.value, b.value) for a, b in zip(whole.trees, cut.trees))


def test_models_are_stored_and_read(spark, tmp_path):
    x, y = data(150, 6)
    df = frame(spark, x, y)
    model = fit_leafwise(df, "y", LeafwiseOptions(rounds=2, leaves=5), prediction="p", nominal={1: 6})
    model.save(str(tmp_path / "m"))
    again = LeafwiseModel.load(str(tmp_path / "m"))
    assert again.binning == model.binning and again.getNumTrees == 2
    assert [r.p for r in again.transform(df).collect()] == [r.p for r in model.transform(df).collect()]


def test_missing_labels_and_empty_tables_are_errors(spark):
    x = np.zeros((3, 1))
    for df in (frame(spark, x, [1, 2, np.nan]), frame(spark, x, [1, 2, 3]).limit(0)):
        with pytest.raises(ValueError, match="training rows"):
            fit_leafwise(df, "y", LeafwiseOptions(rounds=1))


def test_constant_targets_and_features(spark):
    model = fit_leafwise(frame(spark, np.zeros((20, 2)), np.full(20, 7.0)), "y", LeafwiseOptions(rounds=2))
    assert {r["prediction"] for r in model.transform(frame(spark, np.ones((3, 2)), [0, 0, 0])).collect()} == {7.0}


def test_bins():
    binning = Binning(((1.0, 2.0, 5.0), (0.0, 1.0)), (1,))
    values = np.array([[0.5, 0], [1.0, 1], [1.5, 2], [9.0, -1], [np.nan, np.nan]])
    assert binning.bins(values).tolist() == [[1, 1], [1, 2], [2, 0], [3, 0], [0, 0]]
