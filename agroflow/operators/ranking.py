"""Exact ranks without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import bounded, stage

# Fixed layout of monotonically_increasing_id: partition above bit 33, row below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def ranked(df: DataFrame, within: Sequence[str], order_by: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row among the rows with equal ``within`` columns.

    The rows are range-partitioned over the cluster and staged once; a row's
    global position is its position in its partition plus the sizes of the
    partitions before, and its rank is that less the position of its group's
    first row. ``order_by`` must tell the rows of a group apart.
    """
    placed = stage(
        df.orderBy(*within, *order_by).withColumn("_place", F.monotonically_increasing_id()), "ranked"
    ).df.withColumn("_part", F.shiftright("_place", _ROW_BITS))

    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    starts = sizes.select("_part", before.alias("_start"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    positioned = lookup_join(placed, bounded(starts, parts), ["_part"]).withColumn(
        "_position", F.col("_start") + F.col("_place").bitwiseAND(F.lit(_ROW_MASK))
    )
    firsts = positioned.groupBy(*within).agg(F.min("_position").alias("_first"))
    return (
        lookup_join(positioned, firsts, within, spread_by=["_place"])
        .withColumn(name, F.col("_position") - F.col("_first"))
        .drop("_place", "_part", "_start", "_position", "_first")
    )
