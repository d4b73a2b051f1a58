"""Log of training runs: one JSON record per run.

Every append writes a folder of its own, so writers do not meet. A record says how many its batch has: a batch that
lacks some, because its writer was stopped, does not count. Compaction writes all complete batches as one and then
removes them; until they are gone their records occur twice and are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.operators.rows import first_per_key


def _log_path(base_dir: str) -> str:
    return f"{base_dir.rstrip('/')}/experiments"


def new_token() -> str:
    """A token for one call of a job; with a run's name it gives the run's id."""
    return uuid4().hex


def run_id(token: str, run_name: str) -> str:
    return hashlib.md5(f"{token}:{run_name}".encode()).hexdigest()


def run_folder(artifacts_dir: str, token: str, run_name: str) -> str:
    """A run's own folder: its name and the first part of its id."""
    return f"{artifacts_dir.rstrip('/')}/{run_name.replace(' ', '_')}_{run_id(token, run_name)[:8]}"


def run_records(
    metrics: DataFrame,
    family: str,
    feature_names: list[str],
    artifacts_dir: str,
    scalings: Mapping[str, object] | None = None,
    model_class: str = "",
    parameters: Mapping[str, object] | None = None,
    token: str | None = None,
) -> DataFrame:
    """Run records from metric rows (run_name, target, rmse, mae, r2).

    The maps of a record have one entry per target; ``parameters`` are those of
    the learner. The id of a run is fixed by ``token`` and its name, so it does
    not change when the records are evaluated again.
    """
    identity = F.md5(F.concat(F.lit(f"{token or new_token()}:"), F.col("run_name")))
    entry = F.struct("target", F.struct("rmse", "mae", "r2"))
    folder = F.concat(
        F.lit(f"{artifacts_dir.rstrip('/')}/"), F.translate("run_name", " ", "_"), F.lit("_"), F.substring(identity, 1, 8)
    )
    model = F.struct("target", F.struct(
        F.concat(folder, F.lit("/models/"), F.col("target")).alias("artifact_path"),
        F.lit(model_class).alias("class"),
    ))
    runs = metrics.groupBy("run_name").agg(
        F.map_from_entries(F.collect_list(entry)).alias("metrics"),
        F.map_from_entries(F.collect_list(model)).alias("models"),
    )
    transformers = F.lit(None)
    if scalings:
        transformers = F.create_map(*[
            x
            for target, s in scalings.items()
            for x in (F.lit(target), F.struct(
                F.lit(s.kind).alias("kind"), F.lit(s.lam).alias("lambda"),
                F.lit(s.mean).alias("mean"), F.lit(s.std).alias("std"),
            ))
        ])
    return runs.select(
        identity.alias("run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "run_name",
        F.lit(family).alias("model_family_name"),
        F.array(*map(F.lit, feature_names)).cast("array<string>").alias("feature_names"),
        "models",
        transformers.alias("transformers"),
        "metrics",
        folder.alias("artifacts_dir"),
        _text_map(parameters or {}).alias("parameters"),
    )


def _text_map(values: Mapping[str, object]) -> Column:
    """Names and values as a map of text."""
    pairs = [F.lit(str(x)) for name in sorted(values) for x in (name, values[name])]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string, string>")


def append_runs(records: DataFrame, experiment: str, base_dir: str) -> None:
    """Add records to the log; earlier runs stay, and so do those of others that write at the same time."""
    _write_batch(records.withColumn("experiment_name", F.lit(experiment)), base_dir, new_token())


def _write_batch(records: DataFrame, base_dir: str, batch: str) -> None:
    size = records.count()
    if size:
        whole = records.withColumns({"batch": F.lit(batch), "batch_size": F.lit(size)})
        whole.coalesce(1).write.mode("error").json(f"{_log_path(base_dir)}/{batch}")


def _complete_records(spark: SparkSession, base_dir: str) -> DataFrame:
    """The records of complete batches, with their files."""
    schema = f"{schemas.RUN_LOG_SCHEMA}, batch string, batch_size long"
    found = spark.read.schema(schema).option("recursiveFileLookup", True).json(_log_path(base_dir)).withColumn("file", F.col("_metadata.file_path"))
    # A record cut short is no JSON. Logs of one folder per experiment name it in the path only.
    named = F.nullif(F.regexp_extract("file", r"/experiment_name=([^/]+)/", 1), F.lit(""))
    found = found.where(F.col("run_id").isNotNull()).withColumn("experiment_name", F.coalesce("experiment_name", named))
    sizes = found.groupBy("batch").agg(F.count(F.lit(1)).alias("found"))
    whole = found.join(sizes.withColumnRenamed("batch", "of"), F.col("batch").eqNullSafe(F.col("of")))
    return whole.where(F.col("batch").isNull() | (F.col("found") == F.col("batch_size"))).drop("of", "found")


def read_runs(spark: SparkSession, base_dir: str, experiment: str | None = None, latest: bool = False) -> DataFrame:
    """Run records; ``latest`` keeps the newest record of each run name."""
    runs = _complete_records(spark, base_dir).dropDuplicates(["run_id", "timestamp"]).drop("batch", "batch_size", "file")
    if experiment is not None:
        runs = runs.where(F.col("experiment_name") == experiment)
    if latest:
        newest = [F.desc("timestamp"), F.asc("run_id")]
        runs = first_per_key(runs, ["experiment_name", "run_name"], newest)
    return runs


def compact_runs(spark: SparkSession, base_dir: str) -> int:
    """Write all complete batches as one and remove them; returns how many files they had. Batches that are still being
    written, or were cut short, are left alone."""
    found = _complete_records(spark, base_dir)
    files = [r["file"] for r in found.select("file").distinct().collect()]
    if len(files) > 1:
        known = found.where(F.col("file").isin(files)).dropDuplicates(["run_id", "timestamp"])
        _write_batch(known.drop("batch", "batch_size", "file"), base_dir, new_token())
        context = spark.sparkContext
        for file in files:
            path = context._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, False)
    return len(files)


def flatten_runs(runs: DataFrame) -> DataFrame:
    """One row per run and target with its metrics; the fold number comes from the run name's last part."""
    last = F.substring_index("run_name", "_", -1)
    fold = F.regexp_replace(last, "fold", "").try_cast("int")
    return runs.select("run_id", "experiment_name", "run_name", fold.alias("fold"), F.explode("metrics")).select(
        "run_id", "experiment_name", "run_name", "fold", F.col("key").alias("target"), "value.*"
    )


def parameter_rows(runs: DataFrame) -> DataFrame:
    """The log as one row per run and parameter of its learner."""
    return runs.select("run_id", "experiment_name", "run_name", F.explode("parameters").alias("parameter", "value"))


def metric_rows(runs: DataFrame) -> DataFrame:
    """The log as one row per run and named metric, ``<target>_<metric>``."""
    flat = flatten_runs(runs)
    values = F.map_from_arrays(
        F.array(*[F.concat("target", F.lit(f"_{m}")) for m in ("rmse", "mae", "r2")]), F.array("rmse", "mae", "r2")
    )
    return flat.select("run_id", "experiment_name", "run_name", F.explode(values).alias("metric", "value"))
