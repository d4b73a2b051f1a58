"""Fold sizes, group integrity and stability."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agroflow.operators import folds


def one_by_one(loads, weight, groups):
    loads, counts = list(loads), [0] * len(loads)
    for _ in range(groups):
        f = loads.index(min(loads))
        loads[f] += weight
        counts[f] += 1
    return counts


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 60), min_size=1, max_size=7), st.integers(1, 9), st.integers(0, 120)
)
def test_equal_groups_go_where_the_greedy_puts_them(loads, weight, groups):
    assert folds.share_equal_groups(loads, weight, groups) == one_by_one(loads, weight, groups)


def greedy_sizes(sizes, k):
    loads = [0] * k
    for w in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += w
    return loads


def groups_table(spark, sizes):
    data = [(g, i) for g, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, row int")


@pytest.mark.parametrize(
    "sizes", [[10] * 23, [300, *[1] * 400, *[7] * 20], [random.Random(5).randint(1, 12) for _ in range(150)]]
)
def test_group_folds_match_greedy_sizes(spark, sizes):
    folded = folds.group_folds(groups_table(spark, sizes))
    per_fold = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert [per_fold[f] for f in range(1, 6)] == greedy_sizes(sizes, 5)
    assert folded.groupBy("id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    assert folded.count() == sum(sizes)


def test_rows_without_a_group_stay(spark):
    df = groups_table(spark, [3] * 20).union(spark.range(50).selectExpr("null", "cast(id as int)"))
    folded = folds.group_folds(df)
    assert folded.count() == 110 and folded.where("fold is null").count() == 0
    assert folded.where("id is null").select("fold").distinct().count() == 5


def test_group_folds_do_not_depend_on_partitions(spark, same):
    df = groups_table(spark, [random.Random(3).randint(1, 9) for _ in range(60)])
    same(folds.group_folds(df), folds.group_folds(df.repartition(7, "row")))


@pytest.mark.parametrize("n", [3, 10, 1003])
def test_shuffled_folds_have_even_sizes(spark, n):
    folded = folds.shuffled_folds(spark.range(n), ["id"])
    per_fold = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert [per_fold.get(f, 0) for f in range(1, 6)] == [n // 5 + (i < n % 5) for i in range(5)]


def test_shuffled_folds_are_stable_and_seeded(spark, same):
    df = spark.range(500)
    same(folds.shuffled_folds(df, ["id"]), folds.shuffled_folds(df.repartition(9), ["id"]))
    other = folds.shuffled_folds(df, ["id"], seed=7).withColumnRenamed("fold", "other")
    assert folds.shuffled_folds(df, ["id"]).join(other, "id").where("fold <> other").count() > 200


def test_bounds_of_clustered_hashes(spark):
    # Equal leading bits force the search down to the last digit.
    near = spark.range(1000).select((F.lit(1 << 40) + F.col("id")).alias("h"))
    far = spark.range(10).select((F.lit(1 << 62) - F.col("id") * 3).alias("h"))
    hashed = near.union(far)
    bounds = folds._hash_bounds(hashed, [1, 250, 999, 1000, 1005])
    assert [hashed.where(F.col("h") < b).count() for b in bounds] == [1, 250, 999, 1000, 1005]


def test_hash_folds_keep_groups(spark):
    folded = folds.hash_folds(groups_table(spark, [4] * 300), ["id"])
    assert folded.groupBy("id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    counts = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert len(counts) == 5 and min(counts) > 120
