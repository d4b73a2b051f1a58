"""Tables stored by the hash of their key, so that joins on it move nothing.

A panel that is joined by the same key again and again is written once in buckets. Two tables with the same number of
buckets of the same key are joined bucket by bucket, already sorted; a table that is not stored so is the only one
that moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from agroflow.sources.workspace import fresh_path


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as table ``name`` in ``buckets`` files per writing task group, hashed and sorted by ``keys``; returns it.

    ``path`` is its folder, one in the shared folder if not given. A table of that name is replaced. The rows are
    dealt by the keys first, so that each bucket is one file and stays sorted when it is read.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path or fresh_path(spark, name)).saveAsTable(name)
    return read_bucketed(spark, name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets and key of a stored table."""
    columns = spark.catalog.listColumns(name)
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").collect()}
    return int(rows["Num Buckets"]), [c.name for c in columns if c.isBucket]


def join_stored(left: DataFrame, name: str, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``left`` to the stored table ``name``, which does not move: if ``left`` is stored in like buckets nothing
    does, otherwise only ``left`` is dealt by the key into as many parts."""
    spark = left.sparkSession
    buckets, by = bucket_spec(spark, name)
    if list(keys) != by:
        raise ValueError(f"table {name} is stored by {by}, not by {list(keys)}")
    # The sides meet by sorted merge: no side is collected, and buckets come sorted.
    return left.join(read_bucketed(spark, name).hint("merge"), list(keys), how)
