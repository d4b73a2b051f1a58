"""Audit of a chain of document filters: what each removes in every order, and its Shapley share.

The filters are players of a removal game: the value of a coalition is the number of documents that fail at least
one of its filters. Per part of the table, documents are counted by the set of filters they fail, at most 32 numbers;
everything else follows from these. The game's potential (Hart and Mas-Colell) is P(empty) = 0 and
P(S) = (v(S) + the sum of P(S without i) over i in S) / |S|; a filter's Shapley value is the potential of all filters
less the potential without it. What a filter removes at a step is the difference of two coalitions' values.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table
from agroflow.operators.skew import BROADCAST_BYTES, lookup_join
from agroflow.sources.workspace import stage

FILTERS = "ABCDE"
_PLAYERS = range(len(FILTERS))
_COALITIONS = range(1 << len(FILTERS))
ORDERS = math.factorial(len(FILTERS))
_CAPITALS, _SPACES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\t\n\v\f\r "


def text_failures(text: Column) -> Mapping[str, Column]:
    """The filters that a text fails by itself: A under 100 words, B under 80 % different words, C over 10 % of the
    characters capitals, D holds one of ``#$%&*|``."""
    inner = F.btrim(text, F.lit(_SPACES))
    words = F.split(inner, r"[\x20\x09-\x0D]+")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    # An empty text is split into one empty word.
    return {
        "A": (F.size(words) < 100) | (inner == ""),
        "B": (100 * F.size(F.array_distinct(words)) < 80 * F.size(words)) & (inner != ""),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_sets(docs: DataFrame, labels: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(part, failed, n, good, toxic): per lang value, the number of documents that fail exactly this set of filters
    (bit i for the i-th filter), and how many of these are labelled as good and as toxic."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text).values())), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        bits.cast("int").alias("failed"),
    )
    rows = stage(rows, "audit-rows").df
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    copies = stage(copies.filter("copies > 1").select("digest", "first"), "audit-copies")
    marked = lookup_join(rows, copies, ["digest"], "left", spread_by=["doc_id"], broadcast_bytes=broadcast_bytes)
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    marked = marked.withColumn("failed", F.col("failed") + F.when(later, 1 << FILTERS.index("E")).otherwise(0))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    judged = lookup_join(
        marked.select("doc_id", "part", "failed"), stage(marks.filter("doc_id is not null"), "audit-labels"), ["doc_id"], "left",
        spread_by=["doc_id", "failed"], broadcast_bytes=broadcast_bytes,
    )
    return judged.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
    )


def coalition_values(sets: DataFrame) -> DataFrame:
    """(part, all, v_n, v_good, v_toxic): the number of documents, and an array over the 32 coalitions of how many fail
    at least one filter of each."""
    found = sets.groupBy("part").agg(F.sum("n").alias("all"), F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))

    def values(count: str) -> Column:
        def value(coalition: Column) -> Column:
            hit = F.filter("sets", lambda s: s["failed"].bitwiseAND(coalition) != 0)
            return F.aggregate(hit, F.lit(0).cast("long"), lambda total, s: total + s[count])

        return F.transform(F.array(*[F.lit(c) for c in _COALITIONS]), value)

    return found.select("part", "all", *[values(count).alias(f"v_{count}") for count in ("n", "good", "toxic")])


def potentials(values: DataFrame) -> DataFrame:
    """The rows of ``coalition_values`` with ``potential``: 120 times the removal game's potential of each coalition.

    Times 120 all potentials are whole numbers: one is a sum of dividends over coalition sizes 1 to 5.
    """
    bits = F.array(*[F.lit(1 << i) for i in _PLAYERS])

    def next_potential(known: Column, coalition: Column) -> Column:
        members = F.filter(bits, lambda bit: coalition.bitwiseAND(bit) != 0)
        without = F.aggregate(members, F.lit(0).cast("long"), lambda total, bit: total + F.get(known, coalition - bit))
        value = ORDERS * F.get("v_n", coalition)
        return F.array_append(known, F.call_function("div", value + without, F.size(members)))

    # Every coalition comes after those within it: its number is larger.
    coalitions = F.array(*[F.lit(c) for c in _COALITIONS[1:]])
    return values.withColumn("potential", F.aggregate(coalitions, F.array(F.lit(0).cast("long")), next_potential))


def audit_filters(docs: DataFrame, labels: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per part, filter order and step of it: kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley (the filter's removals summed over all 120 orders).

    Parts are the values of ``docs.lang``, null being the empty string. A null text is empty. E fails a text that a
    smaller doc_id has anywhere in the table; rows without a doc_id are never later copies, nor are rows that repeat
    a doc_id copies of each other. A document counts as labelled good (toxic) if any row of ``labels`` says so; null
    labels say nothing. Other columns are ignored. An empty table has no parts and gives no rows.
    """
    everything = _COALITIONS[-1]
    steps = []
    for order in permutations(_PLAYERS):
        before = 0
        for step, player in enumerate(order, start=1):
            steps.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step, "before": before, "own": 1 << player})
            before |= 1 << player
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,before:int,own:int>>")
    parts = stage(potentials(coalition_values(failure_sets(docs, labels, broadcast_bytes))), "audit-parts").df
    rows = parts.withColumn("s", F.explode(plan)).select("*", "s.*").withColumn("after", F.col("before") + F.col("own"))

    def at(array: str, coalition: str | Column) -> Column:
        return F.get(array, F.col(coalition) if isinstance(coalition, str) else coalition)

    removed = at("v_n", "after") - at("v_n", "before")
    without = F.lit(everything) - F.col("own")
    return rows.select(
        "part", "filter_order", "step",
        (F.col("all") - at("v_n", "after")).alias("kept"),
        removed.alias("removed"),
        (at("v_n", "own") - removed).alias("redundant"),
        (at("v_n", F.lit(everything)) - at("v_n", without)).alias("unique_fails"),
        (at("v_good", "after") - at("v_good", "before")).alias("good_lost"),
        (at("v_toxic", "after") - at("v_toxic", "before")).alias("toxic_lost"),
        (at("potential", F.lit(everything)) - at("potential", without)).alias("shapley"),
    )


def op12_filter_potential(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
