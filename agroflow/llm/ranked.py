"""Exact top documents of each query by integer impacts, with norm buckets that prune most documents unseen.

A score is the inner product of a query's weights and a document's impacts, so it is at most the product of their
lengths. The documents' impact vectors are ordered by length over the whole table and stored in that order. The
longest are scored first; their results give each query a threshold. Of the others, rows that are too short for
every query are never read; a bucket of neighbouring rows is left out for each query whose threshold its length
cannot reach (Cauchy-Schwarz). Within a bucket only the postings of a query's heaviest terms are looked at, as many
as it takes so that the others alone cannot reach the threshold: a document's products on these coordinates, plus
the lengths of both vectors on all others, bound its score. Whatever may still reach the threshold is scored exactly
in integers. Bounds are rounded up, so no result is lost.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroflow.llm.common import hash_filter, may_occur, read_table, texts, words_of
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import stage

TOP = 10
#: Rows of a bucket, and of the head that gives the first thresholds.
BUCKET, HEAD = 2048, 8192
#: Bytes of query terms and weights that go to the tasks at once.
BLOCK_BYTES = 8 << 20
#: Bits of the filter that tells which terms no query has.
FILTER_BITS = 24
#: What a bound may lose by rounding, as a share.
_SLACK = 1e-9
_LAST = np.iinfo(np.int64).max

# The parameters of the impacts and the weights.
IMPACT_SCALE, WEIGHT_SCALE = 1_000_000_000, 1000


def term_counts(rows: DataFrame, may_ask: np.ndarray | None = None) -> DataFrame:
    """(id, n, terms, times) of rows (id, text) that have terms: the number of terms with repeats, the different ones
    as 64-bit hashes, and how often each occurs. Given the filter's bits, terms that no query has are left out of the
    lists, not of ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            kept, lengths, terms, times, ends = [], [], [], [], [0]
            for place, text in enumerate(batch.column(1)):
                words = words_of(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                hashes = np.fromiter(map(digest, counts), np.uint64, len(counts))
                often = np.fromiter(counts.values(), np.int32, len(counts))
                if may_ask is not None:
                    asked = may_occur(may_ask, hashes)
                    hashes, often = hashes[asked], often[asked]
                kept.append(place)
                lengths.append(len(words))
                terms.append(hashes.view(np.int64))
                times.append(often)
                ends.append(ends[-1] + len(hashes))
            if kept:
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(kept)), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(terms))),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times)))],
                    ["id", "n", "terms", "times"],
                )

    return rows.mapInArrow(run, "id long, n long, terms array<long>, times array<int>")


def impact_vectors(counts: DataFrame, documents: int, terms: int) -> DataFrame:
    """(doc_id, length, terms, impacts): each document's impacts as 64-bit integers, and the length of that vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, found, times = batch.columns
            offsets = found.offsets.to_numpy()
            at = offsets - offsets[0]
            size = np.diff(at)
            tf = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            norm = np.array([25 + 75 * x * documents // terms for x in n.to_pylist()], np.int64)
            impact = IMPACT_SCALE * tf // (1000 * tf + 8 * np.repeat(norm, size))
            row = np.repeat(np.arange(len(size)), size)
            length = np.sqrt(np.bincount(row, impact.astype(np.float64) ** 2, len(size)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(length), pa.ListArray.from_arrays(pa.array(at, pa.int32()), found.flatten()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(impact))],
                ["doc_id", "length", "terms", "impacts"],
            )

    schema = "doc_id long, length double, terms array<long>, impacts array<long>"
    return counts.select("id", "n", "terms", "times").mapInArrow(run, schema).filter("length > 0")


@dataclass(frozen=True)
class Query:
    """A query's terms, heaviest first, and what a vector of length 1 can bring on all terms from each on."""

    item_id: int | None
    terms: np.ndarray
    weights: np.ndarray
    length: float
    rest: np.ndarray

    @classmethod
    def of(cls, item_id: int | None, terms: list[int], weights: list[int]) -> Query:
        weight = np.array(weights, np.int64)
        order = np.argsort(-weight, kind="stable")
        weight = weight[order]
        squares = np.cumsum((weight.astype(np.float64) ** 2)[::-1])[::-1]
        return cls(item_id, np.array(terms, np.int64)[order], weight, float(np.sqrt(squares[0])), np.sqrt(np.r_[squares, 0.0]))


class Bucket:
    """Neighbouring documents in the order of length, and their postings by term."""

    def __init__(self, ids: np.ndarray, length: np.ndarray, size: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.ids, self.length, self.impacts, self.terms = ids, length, impacts, terms
        self.longest = float(length.max())
        self.starts = np.r_[0, np.cumsum(size)]
        row = np.repeat(np.arange(len(ids)), size)
        order = np.argsort(terms, kind="stable")
        self.by_term, self.row, self.value = terms[order], row[order], impacts[order]

    def candidates(self, query: Query, threshold: int) -> np.ndarray:
        """The documents that may reach the threshold."""
        # Terms up to here are looked at: what is left cannot reach the threshold alone.
        focus = int(np.searchsorted(-query.rest, -threshold / self.longest * (1 - _SLACK), "right")) if threshold else len(query.terms)
        focus = min(focus, len(query.terms))
        low = np.searchsorted(self.by_term, query.terms[:focus], "left")
        found = np.searchsorted(self.by_term, query.terms[:focus], "right") - low
        total = int(found.sum())
        if not total:
            return np.empty(0, np.int64)
        at = np.arange(total) + np.repeat(low - np.cumsum(found) + found, found)
        row, value = self.row[at], self.value[at].astype(np.float64)
        product = np.bincount(row, value * np.repeat(query.weights[:focus], found), len(self.ids))
        square = np.bincount(row, value * value, len(self.ids))
        others = np.sqrt(np.maximum(self.length * self.length * (1 + _SLACK) - square, 0))
        bound = (product + query.rest[focus] * others) * (1 + _SLACK)
        return np.flatnonzero((square > 0) & (bound >= threshold))

    def scores(self, query: Query, rows: np.ndarray) -> np.ndarray:
        """The documents' exact scores."""
        size = self.starts[rows + 1] - self.starts[rows]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.starts[rows] - first, size)
        order = np.argsort(query.terms)
        place = np.minimum(np.searchsorted(query.terms, self.terms[at], sorter=order), len(order) - 1)
        same = query.terms[order[place]] == self.terms[at]
        return np.add.reduceat(np.where(same, query.weights[order[place]] * self.impacts[at], 0), first)


class Search:
    """The best documents of each query among the buckets seen."""

    def __init__(self, queries: list[Query], thresholds: np.ndarray, top: int):
        self.queries, self.top = queries, top
        self.thresholds = thresholds.copy()
        self.lengths = np.array([q.length for q in queries])
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, bucket: Bucket) -> None:
        # Cauchy-Schwarz: only these queries can find anything here.
        for i in np.flatnonzero(self.lengths * bucket.longest * (1 + _SLACK) >= self.thresholds).tolist():
            rows = bucket.candidates(self.queries[i], int(self.thresholds[i]))
            if not len(rows):
                continue
            score = bucket.scores(self.queries[i], rows)
            good = (score >= self.thresholds[i]) & (score > 0)
            if not good.any():
                continue
            score, ids = score[good], bucket.ids[rows[good]]
            if i in self.best:
                score, ids = np.r_[self.best[i][0], score], np.r_[self.best[i][1], ids]
            order = np.lexsort((ids, -score))[: self.top]
            self.best[i] = score[order], ids[order]
            if len(order) == self.top:
                self.thresholds[i] = max(self.thresholds[i], score[order[-1]])

    def results(self) -> Iterator[pa.RecordBatch]:
        if self.best:
            item, ids, score = [], [], []
            for i, (found, documents) in self.best.items():
                item += [self.queries[i].item_id] * len(found)
                ids.append(documents)
                score.append(found)
            ids = np.concatenate(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(ids, mask=ids == _LAST), pa.array(np.concatenate(score))], ["item_id", "doc_id", "score"]
            )


def _searched(ordered: DataFrame, queries: list[Query], thresholds: np.ndarray, top: int, bucket: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(queries, thresholds, top)
        for batch in batches:
            for first in range(0, batch.num_rows, bucket):
                ids, length, terms, impacts = batch.slice(first, bucket).columns
                size = np.diff(terms.offsets.to_numpy())
                ids = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
                search.add(Bucket(ids, length.to_numpy(zero_copy_only=False), size, terms.flatten().to_numpy(), impacts.flatten().to_numpy()))
        yield from search.results()

    return ordered.mapInArrow(run, "item_id long, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of what the tasks found: at most ``top`` rows from each."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, bucket: int = BUCKET, head: int = HEAD,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0, ties by doc_id.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Null texts have no terms. Rows
    of ``docs`` that repeat a doc_id are documents of their own; a null doc_id comes last among equal scores. Repeated
    rows of ``items`` count once, different texts of one item are one query. Items without terms, and all items if no
    document has a term, get no rows. Items whose terms no document has get none either. Terms are told apart by
    64-bit hashes.
    """
    spark = docs.sparkSession
    asked = term_counts(texts(items, "item_id").distinct()).select("id", F.explode(F.arrays_zip("terms", "times")).alias("t"))
    asked = stage(asked.groupBy(F.col("id").alias("item_id"), F.col("t.terms").alias("term")).agg(F.sum("t.times").alias("times")), "asked-terms").df
    counts = stage(term_counts(texts(docs), hash_filter(asked, "term", FILTER_BITS)), "term-counts").df
    totals = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    schema = "item_id long, rank int, doc_id long, score long"
    if not totals["documents"]:
        return spark.createDataFrame([], schema)
    vocabulary = stage(asked.select("term").distinct(), "asked-vocabulary")
    held = lookup_join(counts.select(F.explode("terms").alias("term")), vocabulary, ["term"], "left_semi")
    ratio = F.lit(float(2 * totals["documents"] + 2)) / (2 * F.count(F.lit(1)) + 1)
    weights = stage(held.groupBy("term").agg(F.floor(WEIGHT_SCALE * F.log(ratio)).cast("long").alias("w")).filter("w > 0"), "term-weights")
    entries = lookup_join(asked, weights, ["term"]).groupBy("item_id").agg(
        F.collect_list("term").alias("terms"), F.collect_list(F.col("w") * F.col("times")).alias("weights")
    )
    queries = stage(entries, "query-vectors")
    vectors = impact_vectors(counts, totals["documents"], totals["terms"])
    # Rows of one length, such as copies, may lie in several files.
    order = [F.desc("length"), F.xxhash64("doc_id")]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = stage(vectors.repartitionByRange(partitions, *order).sortWithinPartitions(*order), "impact-vectors")
    share = min(1.0, head / max(1, ordered.rows))
    cut = ordered.df.agg(F.percentile_approx("length", 1 - share, 10_000)).first()[0]
    found = []
    blocks = max(1, -(-queries.bytes // block_bytes))
    for number in range(blocks if cut is not None else 0):
        rows = queries.df.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toLocalIterator()
        block = [Query.of(*row) for row in rows]
        if not block:
            continue
        first = _searched(ordered.df.filter(F.col("length") >= cut), block, np.zeros(len(block), np.int64), top, bucket)
        first = stage(_ranked(first, top).drop("rank"), "head-results").df
        reached = first.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).filter(F.col("n") == top)
        known = {r["item_id"]: r["score"] for r in reached.toLocalIterator()}
        thresholds = np.array([known.get(q.item_id, 0) for q in block], np.int64)
        least = min(t / q.length for t, q in zip(thresholds.tolist(), block)) * (1 - _SLACK)
        tail = ordered.df.filter((F.col("length") < cut) & (F.col("length") >= least))
        rest = _searched(tail, block, thresholds, top, bucket)
        found.append(stage(_ranked(first.unionByName(rest), top), "ranked-documents").df)
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_norm_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
