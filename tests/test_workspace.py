"""Staged tables and their removal."""

import os

from pyspark.sql import SparkSession

from agroflow.sources import workspace


def test_close_removes_this_applications_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda s: str(tmp_path))
    assert isinstance(spark, SparkSession)
    other = tmp_path / "other-application"
    other.mkdir()
    staged = workspace.stage(spark.range(5).toDF("id"), "numbers")
    assert staged.rows == 5 and staged.df.count() == 5
    assert os.path.isdir(workspace.run_folder(spark))
    workspace.close(spark)
    assert not os.path.exists(workspace.run_folder(spark)) and other.exists()
