"""Joins of a big table to a lookup that stay even when one key holds much of the data.

Three physical forms, chosen from measured facts:

* the lookup's measured size is below the limit: broadcast it, the big side does not move;
* otherwise the keys that hold a large share of the big side are counted, and
  only those are spread over salts (and only their lookup rows are repeated);
* no such key: an ordinary shuffled join.

The last two are asked for by name: left to itself, Spark would broadcast a stored lookup by the size of its
compressed files, and the driver would hold it many times larger.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.sources.workspace import StagedTable, measure

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE, LEAST_HOT_SHARE = 0.01, 1e-4


def default_hot_share(spark: SparkSession) -> float:
    """A key is hot if it fills two average shuffle partitions, from one in a hundred down to one in ten thousand rows."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_HOT_SHARE, min(HOT_SHARE, 2 / partitions))


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> dict[int, float]:
    """Hash and share of every key that holds at least ``share`` of the rows.

    Two scans of the key columns. The first keeps at most ``1 / share``
    candidates, whatever the data, and misses none; the second counts them.
    """
    hashed = df.select(F.xxhash64(*on).alias("key_hash"))
    found = hashed.freqItems(["key_hash"], support=share).first()
    if not found or not found[0]:
        return {}
    candidate = F.when(F.col("key_hash").isin(list(found[0])), F.col("key_hash"))
    counts = {r["candidate"]: r["count"] for r in hashed.groupBy(candidate.alias("candidate")).count().collect()}
    total = sum(counts.values())
    return {h: n / total for h, n in counts.items() if h is not None and n >= share * total}


def _row_columns(df: DataFrame) -> list[str]:
    """A panel's identifying columns; all columns of a narrower table."""
    if set(schemas.ROW_IDENTITY) <= set(df.columns):
        return list(schemas.ROW_IDENTITY)
    return df.columns


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame | StagedTable,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float | None = None,
    keys_from: DataFrame | Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on equally named keys.

    ``how`` is one of the types that keep the left side whole or filter it:
    inner, left, left_semi, left_anti. ``spread_by`` are columns that tell the
    rows of one key apart; the salt is a hash of them, so a repeated task gives
    each row the same salt. ``keys_from`` is a table with the same key values per
    row as ``facts`` that is cheaper to scan for hot keys, or a function that makes it when it is needed. The columns of
    ``facts`` come first, in their order.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"lookup_join does not do {how!r} joins")
    on = list(on)
    if isinstance(lookup, StagedTable):
        size, lookup = lookup.bytes, lookup.df
    else:
        size = measure(lookup)[1]
    kept = [f"`{c}`" for c in facts.columns]
    if how in {"inner", "left"}:
        kept += [f"`{c}`" for c in lookup.columns if c not in on]
    if size <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), on, how).select(*kept)

    # Hashes agree only between equal types.
    lookup = lookup.withColumns({c: F.col(c).cast(facts.schema[c].dataType) for c in on})
    counted = facts if keys_from is None else keys_from() if callable(keys_from) else keys_from
    hot = hot_keys(counted, on, hot_share or default_hot_share(facts.sparkSession))
    if not hot:
        return facts.join(lookup.hint("merge"), on, how).select(*kept)

    # Enough salts to cut the hottest key into quarters of an average partition.
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(2, math.ceil(4 * max(hot.values()) * partitions))
    is_hot = F.xxhash64(*on).isin(list(hot))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in (spread_by or _row_columns(facts))])
    salted_facts = facts.withColumn(
        "_salt", F.when(is_hot, F.pmod(row_hash, F.lit(salts)).cast("int")).otherwise(F.lit(0))
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_lookup = lookup.withColumn(
        "_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0))))
    )
    return salted_facts.join(salted_lookup.hint("merge"), [*on, "_salt"], how).select(*kept)
