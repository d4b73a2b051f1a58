"""Connected components of a link table, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroflow.sources.workspace import stage


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both).withColumn("m", F.least("u", "m")), "u")
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    joined = edges.join(_least(edges), "u")
    smaller = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.unionByName(_least(edges).select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
    return tuple(row)


def component_labels(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for each node with a link; the label is the least node of its component.

    ``links`` holds pairs of long ids. Large-star and small-star rounds alternate until the links stop
    changing; each round's links are a table in the shared folder, so a lost executor costs one round.
    No links give an empty result; self links and repeated links change nothing.
    """
    u, v = F.col(f"`{a}`").cast("long"), F.col(f"`{b}`").cast("long")
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u != v").distinct()
    edges = stage(edges, "links").df
    seen = _signature(edges)
    while seen[0]:
        edges = stage(_small_star(_large_star(edges)), "links").df
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
