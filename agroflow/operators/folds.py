"""Cross-validation folds as a column, numbered from 1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroflow.operators.ranking import ranked
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import bounded, fresh_path, stage

#: Rows of the fold plan that the driver holds before it writes them.
BLOCK_ROWS = 50_000
_HASH_BITS = 63
_DIGIT_BITS = 16


def _row_hash(keys: Sequence[str], seed: int):
    """Non-negative 63-bit hash of the row's keys."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed)), 1)


def hash_folds(df: DataFrame, keys: Sequence[str], n_splits: int = 5, seed: int = 42) -> DataFrame:
    """Folds from a hash of the keys: no pass over the data, sizes even on average.

    Equal keys share a fold, so this serves groups as well as rows.
    """
    return df.withColumn("fold", (F.pmod(_row_hash(keys, seed), F.lit(n_splits)) + 1).cast("int"))


def _hash_bounds(hashed: DataFrame, counts: Sequence[int]) -> list[int]:
    """For each count, the bound below which exactly that many hashes lie.

    The hash is read 16 bits at a time: a histogram of the leading bits says in
    which bucket a bound lies, and only those buckets are looked at again.
    Each histogram has at most 65,536 rows per open bound.
    """
    bounds: dict[int, int] = {}
    open_buckets = {0: [(c, c) for c in counts]}  # prefix -> (count, hashes still to pass inside it)
    used = 0
    while open_buckets and used < _HASH_BITS:
        digits = min(_DIGIT_BITS, _HASH_BITS - used)
        shift = _HASH_BITS - used - digits
        inside = hashed if used == 0 else hashed.where(
            F.shiftright("h", _HASH_BITS - used).isin(list(open_buckets))
        )
        histogram: dict[int, list[tuple[int, int]]] = {}
        for r in inside.groupBy(F.shiftright("h", shift).alias("bucket")).count().orderBy("bucket").collect():
            histogram.setdefault(r["bucket"] >> digits, []).append((r["bucket"], r["count"]))
        deeper: dict[int, list[tuple[int, int]]] = {}
        for prefix, wanted in open_buckets.items():
            for count, left in wanted:
                for bucket, rows in histogram.get(prefix, []):
                    if left <= rows:
                        if left == rows or shift == 0:
                            bounds[count] = (bucket + 1) << shift
                        else:
                            deeper.setdefault(bucket, []).append((count, left))
                        break
                    left -= rows
        open_buckets = deeper
        used += digits
    return [bounds[c] for c in counts]


def shuffled_folds(df: DataFrame, keys: Sequence[str], n_splits: int = 5, seed: int = 42) -> DataFrame:
    """Shuffled folds of exactly even size; the first folds take the remainder.

    Rows are ordered by a seeded hash of their key and cut at exact counts, found
    from histograms; no row moves. Rows with equal keys are told apart by their
    rank among each other, so they spread over the folds like all others.
    """
    hashes = stage(df.select(_row_hash(keys, seed).alias("h")), "row-hashes")
    hashed, total = hashes.df, hashes.rows
    repeated = stage(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated-hashes")
    if repeated.rows:
        marked = df.withColumn("_h", _row_hash(keys, seed))
        again = lookup_join(marked, repeated.change(lambda x: x.withColumnRenamed("h", "_h")), ["_h"], "left_semi", keys_from=hashed.withColumnRenamed("h", "_h"))
        alone = lookup_join(marked, repeated.change(lambda x: x.withColumnRenamed("h", "_h")), ["_h"], "left_anti", keys_from=hashed.withColumnRenamed("h", "_h"))
        # Their places in a stored table tell equal rows apart, so that the sort deals out a key's rows, too.
        placed = stage(again.withColumn("_tie", F.monotonically_increasing_id()), "repeated-rows").df
        both = alone.withColumn("_nth", F.lit(0).cast("long")).unionByName(ranked(placed, ["_h"], ["_tie"], "_nth").drop("_tie"))
        numbered = stage(both, "numbered-rows").df
        return shuffled_folds(numbered, ["_h", "_nth"], n_splits, seed).drop("_h", "_nth")
    sizes = [total // n_splits + (i < total % n_splits) for i in range(n_splits)]
    ends = [sum(sizes[: i + 1]) for i in range(n_splits - 1)]
    ends = [e for e in ends if 0 < e < total]
    bounds = _hash_bounds(hashed, ends)
    h = _row_hash(keys, seed)
    fold = sum(((h >= b).cast("int") for b in bounds), F.lit(1))
    return df.withColumn("fold", fold.cast("int"))


def share_equal_groups(loads: list[int], weight: int, groups: int) -> list[int]:
    """How many of ``groups`` equally heavy groups each fold gets if each goes to the lightest fold.

    The order of giving is by (load so far, fold); the result is the count of
    the first ``groups`` steps, found by searching the load level they reach.
    """
    if weight <= 0:
        return [groups if f == 0 else 0 for f in range(len(loads))]

    def given(level: int) -> list[int]:
        return [max(0, -(-(level - load) // weight)) for load in loads]

    low, high = min(loads), max(loads) + weight * groups + 1
    while high - low > 1:
        middle = (low + high) // 2
        if sum(given(middle)) <= groups:
            low = middle
        else:
            high = middle
    counts = given(low)
    left = groups - sum(counts)
    for fold, load in enumerate(loads):
        if left and load + counts[fold] * weight == low:
            counts[fold] += 1
            left -= 1
    return counts


def group_folds(df: DataFrame, group: str = "id", n_splits: int = 5, seed: int = 42) -> DataFrame:
    """Folds balanced by rows in which all rows of a group share a fold.

    Groups go, heaviest first, to the lightest fold. Groups of equal size are
    alike, so the driver only goes through the distinct sizes, in portions, and
    cuts each size's groups, in seeded hash order, into blocks that it writes to
    the shared folder. Rows without a group are spread one by one. Fewer groups
    than folds are an error.
    """
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    spread = F.xxhash64(F.col(group), F.lit(seed))
    ordered = ranked(sizes.withColumn("_spread", spread), ["_size"], ["_spread", group], "_rank")

    spark, path = df.sparkSession, fresh_path(df.sparkSession, "fold-blocks")
    schema = "_size bigint, _from bigint, _to bigint, fold int"
    loads = [0] * n_splits
    blocks: list[tuple] = []
    n_groups = n_blocks = 0

    def write() -> None:
        spark.createDataFrame(blocks, schema).coalesce(1).write.mode("append").parquet(path)
        blocks.clear()

    # The sizes come in portions, heaviest first; the driver keeps the loads alone.
    for r in ordered.groupBy("_size").count().orderBy(F.desc("_size")).toLocalIterator():
        start = 0
        n_groups += r["count"]
        for fold, n in enumerate(share_equal_groups(loads, r["_size"], r["count"])):
            if n:
                blocks.append((r["_size"], start, start + n, fold + 1))
                n_blocks += 1
                loads[fold] += n * r["_size"]
                start += n
        if len(blocks) >= BLOCK_ROWS:
            write()
    if n_groups < n_splits:
        raise ValueError(f"{n_splits} folds need as many groups; there are {n_groups}")
    if blocks:
        write()
    cuts = bounded(spark.read.schema(schema).parquet(path), n_blocks)
    in_block = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    folds = lookup_join(ordered, cuts, ["_size"]).where(in_block).select(group, "fold")
    alone = F.pmod(_row_hash(df.columns, seed), F.lit(n_splits)) + 1
    folded = lookup_join(df, stage(folds, "group-folds"), [group], "left")
    return folded.withColumn("fold", F.coalesce("fold", alone).cast("int"))


def fold_sizes(df: DataFrame) -> DataFrame:
    """Training and validation rows of each fold."""
    per_fold = df.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"))
    # One row per fold.
    total = F.sum("n_val").over(Window.partitionBy())
    return per_fold.select("fold", (total - F.col("n_val")).alias("n_train"), "n_val")
