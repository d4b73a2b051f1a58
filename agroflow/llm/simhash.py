"""SimHash near-duplicates found through Golay-code keys.

Fingerprints with two or fewer differing bits are linked. A fingerprint is cut into three segments. Two
errors leave at least one segment equal, and no other segment has more than two errors. The perfect
binary Golay code assigns every 23-bit word to one codeword at distance 3 or less; a word at distance 3
also has five codewords at distance 4. Two words with two or fewer differing bits always share one of
these codewords, so (equal segment, codeword index of the next segment) is a complete set of keys: three
to eighteen per fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, row_keys, texts
from agroflow.llm.components import component_labels
from agroflow.operators.skew import BROADCAST_BYTES, lookup_join
from agroflow.sources.workspace import stage

BITS = 64
MAX_DISTANCE = 2
SHINGLE_WORDS = 3
SEED = 42
#: Keys shared by more fingerprints are refined by the codewords of the third segment.
REFINE_ABOVE = 2048

# Fixed value: a generator polynomial of the (23, 12) Golay code.
_GENERATOR = 0b101011100011
_WIDTHS = (22, 21, 21)


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and per syndrome its error patterns and their number."""
    single = [_syndrome(1 << i) for i in range(23)]
    low = np.zeros(1 << 12, np.int64)
    high = np.zeros(1 << 11, np.int64)
    for table, first in ((low, 0), (high, 12)):
        for i in range(len(table)):
            for bit in range(i.bit_length()):
                if i >> bit & 1:
                    table[i] ^= single[first + bit]
    patterns = np.zeros((2048, 6), np.int64)
    count = np.zeros(2048, np.int64)
    for weight in range(5):
        for places in combinations(range(23), weight):
            s = word = 0
            for i in places:
                s ^= single[i]
                word |= 1 << i
            # Weight 4 counts only beside a pattern of weight 3.
            if weight < 4 or count[s] and bin(int(patterns[s, 0])).count("1") == 3:
                patterns[s, count[s]] = word
                count[s] += 1
    return low, high, patterns, count


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: (position of the word, 12-bit index of a near codeword), one row per codeword."""
    low, high, patterns, count = golay_tables()
    syndromes = low[words & 0xFFF] ^ high[words >> 12]
    n = count[syndromes]
    rows = np.repeat(np.arange(len(words)), n)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, (words[rows] ^ patterns[syndromes[rows], nth]) >> 11


def segments(prints: np.ndarray) -> list[np.ndarray]:
    """The three segments of unsigned 64-bit fingerprints."""
    out, shift = [], 0
    for width in _WIDTHS:
        out.append(((prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    return out


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) rows."""
    parts = segments(prints)
    rows, keys = [], []
    for s in range(3):
        at, index = codeword_indices(parts[(s + 1) % 3])
        rows.append(at)
        keys.append((np.int64(s) << 34) | (parts[s][at] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Majority of the shingle hashes' bits; fewer words than a shingle are one shingle, no words give 0."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = (ends - np.fromiter(map(len, tokens), np.int64, len(tokens)) - 1)[: len(tokens) - words + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts.tolist(), (ends[words - 1 :] - 1).tolist())),
        np.uint64, len(starts),
    )
    counts = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 4096):
        block = hashes[first : first + 4096]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(BITS, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), words, seed) for t in batch.column(1)]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def _keys(prints: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for first in range(0, len(fp), 8192):
                block = fp[first : first + 8192]
                rows, keys = keys_of(block.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.zeros(len(keys), np.int32)), pa.array(block[rows])], ["key", "sub", "fp"]
                )

    return prints.select("fp").mapInArrow(run, "key long, sub int, fp long")


def _refined(keyed: DataFrame) -> DataFrame:
    """Rows of a crowded key under the near codewords of the segment that the key leaves out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(2).to_numpy(zero_copy_only=False)
            parts = np.stack(segments(fp.view(np.uint64)))
            third = parts[((key >> 34) + 2) % 3, np.arange(len(fp))]
            rows, index = codeword_indices(third)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[rows]), pa.array((index + 1).astype(np.int32)), pa.array(fp[rows])], ["key", "sub", "fp"]
            )

    return keyed.mapInArrow(run, "key long, sub int, fp long")


def _stars(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A star of links for each connected set of distinct fingerprints; its center is the first one reached."""
    left = np.unique(prints)
    centers, members = [], []
    while len(left) > 1:
        center, left = left[0], left[1:]
        frontier = [center]
        while frontier and len(left):
            near = np.bitwise_count(left.view(np.uint64) ^ np.uint64(frontier.pop().view(np.uint64))) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                frontier.extend(found)
                members.append(found)
                centers.append(np.full(len(found), center))
    if not members:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(centers), np.concatenate(members)


def _verified(keyed: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that span the connected fingerprints of each key; the partitions are sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None

        def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
            edges = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.r_[0, edges], np.r_[edges, len(key)]
            found = [_stars(fp[i:j], distance) for i, j in zip(starts, ends) if j - i > 1]
            found = [x for x in found if len(x[0])]
            if not found:
                return None
            a, b = (np.concatenate(x) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False) << 13 | batch.column(1).to_numpy(zero_copy_only=False)
            fp = batch.column(2).to_numpy(zero_copy_only=False)
            if kept is not None:
                key, fp = np.r_[kept[0], key], np.r_[kept[1], fp]
            # The last key may go on in the next batch.
            cut = np.searchsorted(key, key[-1]) if len(key) else 0
            kept = key[cut:], fp[cut:]
            if cut and (out := links(key[:cut], fp[:cut])) is not None:
                yield out
        if kept is not None and (out := links(*kept)) is not None:
            yield out

    return keyed.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, distance: int = MAX_DISTANCE, refine_above: int = REFINE_ABOVE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect all within ``distance``.

    The links span the same components as all pairs within the distance, without listing those pairs.
    A key with more than ``refine_above`` fingerprints is split further by the third segment's codewords,
    which keeps every pair together. ``distance`` is at most 2, what the keys guarantee.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError("the Golay keys find fingerprints with 0 to 2 differing bits")
    keys = stage(_keys(prints.select("fp").distinct()), "golay-keys").df
    several = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-golay-keys")
    shared = lookup_join(keys, several, ["key"], spread_by=["fp"])
    split = shared.filter(F.col("n") <= refine_above).drop("n").unionByName(
        _refined(shared.filter(F.col("n") > refine_above).drop("n"))
    )
    placed = split.repartition("key", "sub").sortWithinPartitions("key", "sub")
    return _verified(placed, distance)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, fingerprint as 16 hex
    digits, component_id (the least doc_id reachable through links).

    Null and empty texts have fingerprint zero and are linked like any other. Equal rows come out as often as
    they go in. A row without a doc_id takes its component from the others, and is null if there are none.
    An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, words), "fingerprints").df
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = component_labels(links(rows, distance), "a", "b").select(F.col("node").alias("fp"), "label")
    labelled = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = stage(labelled.join(least, "label").select("fp", "component_id"), "simhash-classes").df
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first_copies(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row of ``docs`` of each near-duplicate component, with all its columns: that with the least doc_id.

    Rows without a doc_id come last. Among rows that share the least doc_id, the one with the least hash of the whole
    row stays, so a repeated run keeps the same one; of equal rows one stays. Null and empty texts are copies of each
    other. Columns of any name are allowed. An empty table stays empty.
    """
    rows = row_keys(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "row_hash", "fp"])

    keyed = rows.select("doc_id", "row_hash", "text").mapInArrow(run, "doc_id long, row_hash long, fp long")
    keyed = stage(keyed, "row-prints").df
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_hash")
    counted = keyed.groupBy("fp", "doc_id", "row_hash").agg(F.count(F.lit(1)).alias("n"))
    classes = stage(counted.groupBy("fp").agg(F.min(F.struct(order.alias("at"), "n")).alias("first")), "print-classes").df
    labels = component_labels(links(classes, distance), "a", "b").select(F.col("node").alias("fp"), "label")
    labelled = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    firsts = labelled.groupBy("label").agg(F.min("first").alias("first"))
    kept = firsts.select("first.at.missing", F.coalesce("first.at.doc_id", F.lit(0)).alias("id"), "first.at.row_hash", "first.n")
    rows = rows.select("row", F.col("doc_id").isNull().alias("missing"), F.coalesce("doc_id", F.lit(0)).alias("id"), "row_hash")
    key = ["missing", "id", "row_hash"]
    met = lookup_join(rows, stage(kept, "first-copies"), key, spread_by=["id", "row_hash"], broadcast_bytes=broadcast_bytes)
    return met.filter("n = 1").unionByName(met.filter("n > 1").dropDuplicates(key)).select("row.*")


def op9_simhash_golay(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))
