"""Threshold-scaled fingerprints, with DataFrame functions only.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so it grows with its text
and the fingerprint of a union is the union of fingerprints. Shared hashes over the hashes of the smaller
side estimate containment, however unequal the two texts are. The least hash is kept, too, so that a text
with words never has an empty fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroflow.llm.common import ascii_lower, read_table, texts
from agroflow.sources.workspace import stage

SHINGLE_WORDS = 5
#: One hash in 2 to this power is kept.
SCALE_BITS = 3

# Fixed layout of monotonically_increasing_id: the partition above bit 33.
_ROW_BITS = 33


def sketch(text: Column, words: int = SHINGLE_WORDS, scale_bits: int = SCALE_BITS) -> Column:
    """Sorted, distinct hashes of the word shingles (lower case) below the threshold, and the least hash.

    Fewer words than a shingle are one shingle; a text without words has an empty sketch, a null one null.
    """
    tokens = F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashes(tokens: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - (words - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(tokens, i, words), " ")))

    def kept(all_hashes: Column) -> Column:
        below = F.filter(all_hashes, lambda h: F.shiftrightunsigned(h, 64 - scale_bits) == 0)
        # Flipping the sign bit turns the unsigned order into the signed one.
        least = F.array_min(F.transform(all_hashes, lambda h: h.bitwiseXOR(F.lit(-(1 << 63))))).bitwiseXOR(F.lit(-(1 << 63)))
        return F.array_sort(F.array_distinct(F.concat(F.array(least), below)))

    # A variable of one element keeps each step from being computed again by the next.
    once = F.transform(F.array(tokens), lambda t: F.when(F.size(t) > 0, hashes(t)).otherwise(F.array().cast("array<bigint>")))
    return F.transform(once, lambda h: F.when(F.size(h) > 0, kept(h)).otherwise(h))[0]


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other one has; 1 for two empty sketches, 0 for one."""
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)) / least
    return F.when(least > 0, shared).otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def merge(a: Column, b: Column, scale_bits: int = SCALE_BITS) -> Column:
    """The sketch of two texts' shingles together."""
    flip = lambda h: h.bitwiseXOR(F.lit(-(1 << 63)))
    both = F.array_union(a, b)
    least = flip(F.array_min(F.transform(both, flip)))
    return F.array_sort(F.filter(both, lambda h: (F.shiftrightunsigned(h, 64 - scale_bits) == 0) | (h == least)))


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def successors(rows: DataFrame) -> DataFrame:
    """Each different row (id, missing, text_hash) with the row after it in descending order of id, then hash.

    Columns: id, missing, text_hash, half, next_id, next_hash and copies. The last row
    is followed by the first. Repeated rows follow each other, so they give up to two lines: one for the
    copies before a copy of themselves, one for the last. Rows whose id is missing come last. The rows are sorted
    over the cluster once; only one line for each sorted partition meets in a single task.
    """
    order = [F.col("missing"), F.col("id").desc(), F.col("text_hash")]
    counted = rows.groupBy("id", "missing", "text_hash", "half").agg(F.count(F.lit(1)).alias("n"))
    placed = stage(counted.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "row-order").df
    placed = placed.withColumn("part", F.shiftright("place", _ROW_BITS))
    key = F.struct("id", "text_hash")
    within = Window.partitionBy("part").orderBy("place")
    heads = placed.groupBy("part").agg(F.min_by(key, "place").alias("head"))
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        "part", F.coalesce(F.lead("head").over(Window.orderBy("part")), F.first("head").over(parts)).alias("after")
    )
    following = placed.withColumn("next", F.lead(key).over(within)).join(after, "part").withColumn("next", F.coalesce("next", "after"))
    last = following.select("id", "missing", "text_hash", "half", "next", F.lit(1).cast("long").alias("copies"))
    repeated = following.filter("n > 1").select("id", "missing", "text_hash", "half", key.alias("next"), (F.col("n") - 1).alias("copies"))
    return last.unionByName(repeated).select(
        "id", "missing", "text_hash", "half", "copies", F.col("next.id").alias("next_id"), F.col("next.text_hash").alias("next_hash")
    )


def edited_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, scale_bits: int = SCALE_BITS) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text; other columns are ignored) and of its edited text.

    The edited text has the last half of the characters replaced by the start of the next document's text in
    descending order of doc_id. Null and empty texts have empty fingerprints. Repeated rows come out as often
    as they go in; an empty table gives no rows.
    """
    # A row's key is never null, so that all joins share the partitioning of one exchange.
    missing = F.col("doc_id").isNull()
    rows = texts(docs).select(
        "text", F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.when(missing, F.xxhash64("text", F.lit("no id"))).otherwise(F.xxhash64("text")).alias("text_hash"), missing.alias("missing"),
    )
    chain = stage(successors(rows.select("id", "missing", "text_hash", F.expr("length(text) div 2").alias("half"))), "row-chain").df
    whole = rows.groupBy("id", "text_hash").agg(F.first("text").alias("text"))
    following = chain.withColumnsRenamed({"id": "of_id", "text_hash": "of_hash", "next_id": "id", "next_hash": "text_hash"})
    starts = following.join(whole, ["id", "text_hash"]).select(
        F.col("of_id").alias("id"), F.col("of_hash").alias("text_hash"), "missing", "copies",
        F.expr("substring(text, 1, cast(half as int))").alias("start"), sketch(F.col("text"), words, scale_bits).alias("next_sketch"),
    )
    edited = whole.join(starts, ["id", "text_hash"]).select(
        F.when(~F.col("missing"), F.col("id")).alias("doc_id"), sketch(F.col("text"), words, scale_bits).alias("sketch"),
        "next_sketch", "copies", F.length("text").cast("long").alias("n_chars"),
        F.concat(F.expr("substring(text, 1, length(text) - cast(length(text) div 2 as int))"), "start").alias("edited"),
    )
    compared = edited.withColumn("edited_sketch", sketch(F.col("edited"), words, scale_bits))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        F.explode(F.expr("array_repeat(0, cast(copies as int))")).alias("copy"),
    ).drop("copy")


def op6_scaled_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, folder, "documents"))
