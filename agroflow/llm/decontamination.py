"""Benchmark passages in training text: rare n-gram seeds, then Smith-Waterman alignment.

An item's seeds are its n-grams of the rarest words, one from every few that follow each other, so that any
stretch left unedited holds one. Seeds and items are tables, whatever their number: one pass over the documents
counts the words that items have, a second one finds the places of seeds, which are joined to the seeds' table. The
document around such a place is aligned with the item, word by word. Of the benchmark only two filters of fixed
size, over its words and its seeds, go to the tasks; words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import hash_filter, may_occur, read_table, row_keys, texts, words_of
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import stage

#: Words of a seed, and how many seeds in a row at least one is kept of.
SEED_WORDS, SEED_WINDOW = 3, 3
#: Alignment score over the score of the item with itself.
MIN_SCORE = 0.7
MATCH, MISMATCH, GAP = 2, -1, 1
#: Bits of the filters over the benchmark's words and seeds.
FILTER_BITS = 24
#: Documents whose words a task holds at once.
STEP_ROWS = 250
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def align(document: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(best Smith-Waterman score, position after its last word in the document) of two sequences of word numbers."""
    column = np.arange(1, len(document) + 1) * GAP
    row = np.zeros(len(document) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        reached = np.maximum(row[:-1] + np.where(document == word, MATCH, MISMATCH), row[1:] - GAP)
        # A gap in the item: the best earlier cell of the row, less what lies between.
        reached = np.maximum(np.maximum.accumulate(np.maximum(reached, 0) + column) - column, 0)
        row = np.concatenate(([0], reached))
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def ngram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ words[k : n + k]) * _MULTIPLY
        out ^= out >> np.uint64(31)
    return out


def rare_seeds(words: np.ndarray, rarity: np.ndarray, seed_words: int = SEED_WORDS, seed_window: int = SEED_WINDOW) -> list[int]:
    """The places of an item's seeds: of every ``seed_window`` n-grams in a row, the one of the rarest words."""
    size = min(seed_words, len(words))
    sums = sum(rarity[k : len(words) - size + 1 + k] for k in range(size))
    return sorted({first + int(sums[first : first + seed_window].argmax()) for first in range(max(1, len(sums) - seed_window + 1))})


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words): the different items that have words; ``item`` is a key of item_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*key, _hashed(words).view(np.int64)) for *key, text in zip(*(c.to_pylist() for c in batch.columns)) if (words := words_of(text))]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["item", "item_id", "words"])

    rows = texts(benchmark, "item_id").withColumnRenamed("doc_id", "item_id").distinct()
    keyed = rows.select(F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item"), "item_id", "text")
    return keyed.mapInArrow(run, "item long, item_id long, words array<long>")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in small steps: what a step holds of them bounds a worker's memory."""
    for batch in batches:
        for first in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(first, STEP_ROWS)


def _word_documents(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(word, n): in how many documents each word that the filter lets through is; word 0 stands for all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            seen: Counter[bytes] = Counter()
            for text in batch.column(0):
                seen.update(set(words_of(text.as_py())))
            hashes = _hashed(list(seen))
            n = np.fromiter(seen.values(), np.int64, len(seen))
            known = may_occur(wanted, hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[np.int64(0), hashes[known].view(np.int64)]), pa.array(np.r_[batch.num_rows, n[known]])], ["word", "n"]
            )

    return texts(docs).select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _seeds(items: DataFrame, frequency: DataFrame, documents: int) -> DataFrame:
    """(seed, item, place, length): the seeds of all items, their places there, and the items' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, listed in zip(*(c.to_pylist() for c in batch.columns)):
                words = np.array([w["word"] for w in listed], np.int64).view(np.uint64)
                rarity = np.log((documents + 1) / (np.array([w["n"] for w in listed], np.float64) + 1))
                hashes = ngram_hashes(words, min(SEED_WORDS, len(words))).view(np.int64)
                out += [(int(hashes[place]), item, place, len(words)) for place in rare_seeds(words, rarity)]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["seed", "item", "place", "length"])

    placed = items.select("item", F.posexplode("words").alias("at", "word"))
    known = lookup_join(placed, stage(frequency, "benchmark-words"), ["word"], "left", spread_by=["item", "at"])
    # An item's words come together: as many as its text has.
    listed = known.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("at", "word", F.coalesce("n", F.lit(0)).alias("n")))).alias("listed"))
    return listed.mapInArrow(run, "seed long, item long, place int, length int")


def _seed_places(docs: DataFrame, wanted: np.ndarray, sizes: list[int]) -> DataFrame:
    """(row, doc_id, words, hits): the documents with places (seed, at) that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in _slices(batches):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                number += 1
                words = _hashed(words_of(text.as_py()))
                hits = []
                for size in sizes:
                    hashes = ngram_hashes(words, size)
                    at = np.flatnonzero(may_occur(wanted, hashes))
                    hits += zip(hashes[at].view(np.int64).tolist(), at.tolist())
                if hits:
                    out.append((number, doc_id, words.view(np.int64), [{"seed": s, "at": a} for s, a in hits]))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["row", "doc_id", "words", "hits"])

    return texts(docs).mapInArrow(run, "row long, doc_id long, words array<long>, hits array<struct<seed: long, at: int>>")


def _windows(starts: list[int], length: int, n: int) -> list[tuple[int, int]]:
    """Stretches of the document around the places where an item may begin, those that touch joined."""
    slack = length // 2 + 1
    out: list[tuple[int, int]] = []
    for start in sorted(starts):
        low, high = max(0, start - slack), min(n, start + length + slack)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _stretches(found: DataFrame) -> DataFrame:
    """The stretches (low, part) of the documents that an item may lie in, from (row, doc_id, item, starts, length, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for k, (row, doc_id, item, starts, length) in enumerate(zip(*columns)):
                words = batch.column(5)[k].values.to_numpy(zero_copy_only=False)
                out = [(row, doc_id, item, len(words), low, words[low:high]) for low, high in _windows(starts, length, len(words))]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["row", "doc_id", "item", "n_words", "low", "part"])

    columns = found.select("row", "doc_id", "item", "starts", "length", "words")
    return columns.mapInArrow(run, "row long, doc_id long, item long, n_words long, low long, part array<long>")


def _aligned(stretches: DataFrame, min_score: float) -> DataFrame:
    """(row, doc_id, item, item_id, n_words, score, end_word) of the stretches that score enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(6))))
            out = []
            for k, (row, doc_id, item, item_id, n_words, low) in enumerate(keys):
                part, words = (batch.column(i)[k].values.to_numpy(zero_copy_only=False) for i in (6, 7))
                # Words of the item that are not there cannot be aligned.
                if np.isin(words, part).mean() < min_score:
                    continue
                score, stop = align(part, words)
                if score / (MATCH * len(words)) >= min_score:
                    out.append((row, doc_id, item, item_id, n_words, score / (MATCH * len(words)), low + stop))
            if out:
                kinds = (*[pa.int64()] * 5, pa.float64(), pa.int64())
                names = ["row", "doc_id", "item", "item_id", "n_words", "score", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    schema = "row long, doc_id long, item long, item_id long, n_words long, score double, end_word long"
    return stretches.select("row", "doc_id", "item", "item_id", "n_words", "low", "part", "words").mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, end_word, n_words): each row of ``docs`` with each benchmark item found in it.

    The score is the best local alignment over that of the item with itself, ``min_score`` at least. An item is found
    if enough words in a row are left as they were: ``SEED_WORDS + SEED_WINDOW - 1``, or all of a shorter one. Null
    and empty texts match nothing, items without words are never found. Repeated rows give repeated matches,
    repeated items one. A null doc_id or item_id is kept. Empty tables give no rows.
    """
    items = stage(_items(benchmark), "benchmark-items")
    schema = "doc_id long, item_id long, score double, end_word long, n_words long"
    if not items.rows:
        return docs.sparkSession.createDataFrame([], schema)
    vocabulary = items.df.select(F.explode("words").alias("word")).distinct()
    frequency = stage(_word_documents(docs, hash_filter(vocabulary, "word", FILTER_BITS)), "word-documents").df
    documents = frequency.filter("word = 0").agg(F.sum("n")).first()[0] or 0
    seeds = stage(_seeds(items.df, frequency.join(vocabulary, "word", "left_semi"), documents), "benchmark-seeds")
    sizes = sorted(r["size"] for r in seeds.df.select(F.least("length", F.lit(SEED_WORDS)).alias("size")).distinct().collect())
    places = stage(_seed_places(docs, hash_filter(seeds.df, "seed", FILTER_BITS), sizes), "seed-places").df
    hits = places.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    met = lookup_join(hits, seeds, ["seed"], spread_by=["row", "at"])
    starts = F.array_sort(F.collect_set(F.col("at") - F.col("place"))).alias("starts")
    pairs = met.groupBy("row", "item").agg(starts, F.first("length").alias("length"))
    # Stored, so that no task keeps one Python worker to cut and another to align.
    stretches = stage(_stretches(places.select("row", "doc_id", "words").join(pairs, "row")), "item-stretches").df
    scored = _aligned(lookup_join(stretches, items, ["item"], spread_by=["row", "low"]), min_score)
    best = F.max(F.struct("score", (-F.col("end_word")).alias("sooner"))).alias("best")
    found = scored.groupBy("row", "doc_id", "item", "item_id", "n_words").agg(best)
    return found.select("doc_id", "item_id", "best.score", (-F.col("best.sooner")).alias("end_word"), "n_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` without a benchmark item, with all their columns, whatever their names.

    Rows are judged by their text alone: null and empty texts stay, repeated rows share their fate, and rows without a
    doc_id are judged like any other. Empty tables, of documents or of items, drop nothing.
    """
    rows = row_keys(docs).select("row", "row_hash", F.xxhash64("text").alias("text_hash"), "text")
    keyed = rows.select(F.col("text_hash").alias("doc_id"), "text")
    found = contaminated(keyed, benchmark, min_score).select(F.col("doc_id").alias("text_hash")).distinct()
    return lookup_join(rows, stage(found, "contaminated"), ["text_hash"], "left_anti", spread_by=["row_hash"]).select("row.*")


def op8_seeded_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.withColumn("score", F.round("score", 6))
