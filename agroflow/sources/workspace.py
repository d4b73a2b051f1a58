"""Intermediate tables written to the cluster's shared folder.

A staged table cuts lineage in a way that survives the loss of executors, is
computed once, and comes with its exact row count and size for free.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable
from dataclasses import dataclass, replace
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folders: dict[str, str] = {}

_FIXED_WIDTH = 8
_ROW_OVERHEAD = 16
_UNBOUNDED = 1 << 40
#: Rows that a task gets of a table that is dealt out by its row count.
ROWS_PER_TASK = 200_000


@dataclass(frozen=True)
class StagedTable:
    """A table of known size: counted while it was written, or bounded by construction."""

    df: DataFrame
    rows: int
    bytes: int

    def change(self, edit: Callable[[DataFrame], DataFrame]) -> StagedTable:
        """The same rows under other names or with columns left out."""
        return replace(self, df=edit(self.df))


def dealt(df: DataFrame, rows: int, *columns) -> DataFrame:
    """``df``, which has ``rows`` rows, partitioned by the columns into as many parts as keep a task's share of it bounded.

    The number is a stated one, so adaptive execution does not join the parts to larger ones again.
    """
    return df.repartition(max(1, math.ceil(rows / ROWS_PER_TASK)), *columns)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="agroflow-")
        context.setCheckpointDir(_local_folders[app])
    return _local_folders[app]


def run_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one; all its staged tables lie there."""
    return f"{shared_folder(spark)}/agroflow-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid4().hex}"


def close(spark: SparkSession) -> None:
    """Remove all tables that this application has staged; results that still read them must be written first."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def size_aggregates(schema: T.StructType) -> tuple[list, int]:
    """Aggregates that give a table's row count and variable-length bytes, and its fixed row width.

    Columns of user-defined types (feature vectors) count as too wide to broadcast.
    """
    width = _ROW_OVERHEAD
    lengths = []
    for field in schema.fields:
        width += _FIXED_WIDTH
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.UserDefinedType):
            width += _UNBOUNDED
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            lengths.append(F.octet_length(column))
        elif not isinstance(field.dataType, (T.NumericType, T.DateType, T.TimestampType,
                                             T.TimestampNTZType, T.BooleanType)):
            lengths.append(F.octet_length(F.to_json(F.struct(column))) * 2)
    total = sum((F.coalesce(x.cast("bigint"), F.lit(0)) for x in lengths), F.lit(0).cast("bigint"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).alias("text")], width


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a table by one aggregate over it."""
    aggregates, width = size_aggregates(df.schema)
    row = df.agg(*aggregates).first()
    return row["rows"], row["rows"] * width + row["text"]


def bounded(df: DataFrame, rows: int) -> StagedTable:
    """A table of fixed-width columns that cannot have more than ``rows`` rows."""
    return StagedTable(df, rows, rows * (_ROW_OVERHEAD + _FIXED_WIDTH * len(df.columns)))


def stage(df: DataFrame, label: str, parts: str | None = None) -> StagedTable:
    """Write ``df`` once to the shared folder and read it back, with its measured size.

    ``parts`` names a column of a few whole numbers; each has its own files, so a filter on it does not read the others'.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    aggregates, width = size_aggregates(df.schema)
    seen = Observation()
    writer = df.observe(seen, *aggregates).write
    (writer if parts is None else writer.partitionBy(parts)).parquet(path)
    rows, text = seen.get["rows"], seen.get["text"]
    stored = spark.read.schema(df.schema).parquet(path)
    if parts is not None:
        # The column that names folders is read last.
        stored = stored.select(*[f"`{c}`" for c in df.columns])
    return StagedTable(stored, rows, rows * width + text)
