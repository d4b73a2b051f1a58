"""Regression metrics and their roll-ups over folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("rmse", "mae", "r2")
# Fixed value: label of the rows that average the folds.
FOLD_MEAN = "OOF"


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """RMSE, MAE and R2 of ``y_pred`` against ``y`` per group, in one pass.

    All come from the ``n`` rows that have both values; ``n_missing`` counts the others.
    """
    y, predicted = (F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in ("y", "y_pred"))
    both = y.isNotNull() & predicted.isNotNull()
    error = F.when(both, predicted - y)
    sums = predictions.groupBy(*by).agg(
        F.count_if(both).alias("n"),
        F.count_if(~both).alias("n_missing"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(F.when(both, y)).alias("variance"),
    )
    constant = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    return sums.select(
        *by,
        "n",
        "n_missing",
        F.sqrt("mse").alias("rmse"),
        "mae",
        F.when(F.col("variance") == 0, constant).otherwise(1 - F.col("mse") / F.col("variance")).alias("r2"),
    )


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the folds of a target."""
    return fold_metrics.groupBy("target").agg(
        F.count(F.lit(1)).alias("n_folds"),
        *[F.avg(m).alias(f"mean_{m}") for m in METRICS],
        *[F.stddev_pop(m).alias(f"std_{m}") for m in METRICS],
    )


def cv_report(fold_metrics: DataFrame) -> DataFrame:
    """Fold rows and one mean row per target, sorted by target and fold, the mean last."""
    columns = ["target", "fold", *METRICS]
    per_fold = fold_metrics.select("target", F.col("fold").cast("string").alias("fold"), *METRICS)
    means = (
        fold_metrics.groupBy("target").agg(*[F.avg(m).alias(m) for m in METRICS]).withColumn("fold", F.lit(FOLD_MEAN))
    )
    both = per_fold.unionByName(means)
    return both.orderBy("target", F.col("fold").try_cast("int").asc_nulls_last()).select(*columns)
