"""Cross-validation report from the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agroflow.operators.metrics import cv_report
from agroflow.sources.run_log import flatten_runs, read_runs
from agroflow.sources.tables import write_csv


def report(spark: SparkSession, log_dir: str, experiment: str, latest: bool = True) -> DataFrame:
    """Fold metrics and their means per target, of the newest run of each fold."""
    return cv_report(flatten_runs(read_runs(spark, log_dir, experiment, latest)))


def write_report(spark: SparkSession, log_dir: str, experiment: str, path: str) -> None:
    write_csv(report(spark, log_dir, experiment).coalesce(1), path)
