"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

The plan needs only how many pieces there are of each length, at most ``capacity`` numbers. Pieces above a
third of the capacity are matched greedily, at most two to a sequence; shorter ones go, longest first, into
the tightest gap left. Sequences with the same contents are planned as one range, and a piece finds its
place in the plan by its rank among the pieces of its length.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, texts
from agroflow.sources.workspace import stage

CAPACITY = 1024
END_ID = 2
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


#: Characters on which both libraries are tested to cut and encode alike.
_OTHER = re.compile("[^\x00-\u024f\u2010-\u203a\u20ac]")


class TokenEncoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes, as ``tokenizers`` gives them.

    Given the rank file of the same vocabulary, texts of Latin letters and usual marks go through the faster
    ``tiktoken``, whose ids are the same. Texts with other characters, or with the text of a special token,
    always go through ``tokenizers``.
    """

    def __init__(self, path: str, ranks_path: str | None):
        self._path = path
        with open(path, encoding="utf-8") as file:
            self._special = [t["content"] for t in json.load(file)["added_tokens"]]
        self._fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def _tokenizer(self):
        """Loaded for the first text that needs it; most tasks do without its memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._path)

    def encode(self, text: str) -> bytes:
        if self._fast is None or any(s in text for s in self._special) or _OTHER.search(text):
            ids = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        else:
            ids = self._fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None) -> TokenEncoder:
    """One encoder for each worker process."""
    return TokenEncoder(path, ranks_path)


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, after a first one that takes the rest."""
    first = n_tokens % capacity or capacity
    pieces = [(0, min(first, n_tokens))]
    pieces += [(start, capacity) for start in range(first, n_tokens, capacity)]
    return pieces


def token_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of every document with their ids' checksum, the task that made them (``part``), and their
    number among that task's pieces of the same length (``nth``)."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, ranks_path).encode
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                block = batch.slice(at, 256)
                out = []
                for doc_id, text in zip(block.column(0).to_pylist(), block.column(1)):
                    raw = encode(text.as_py()) + end
                    for piece, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                        out.append((doc_id, piece, start, length, crc, part, seen[length]))
                        seen[length] += 1
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return texts(docs).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


@dataclass(frozen=True)
class Placement:
    """Pieces of one length, by rank from ``rank`` on: ``each`` to a sequence from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    n: int
    sequence: int
    each: int
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {s: n for s, n in sorted(counts.items()) if n}
        self.rank = dict.fromkeys(self.left, 0)
        self.placements: list[Placement] = []
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []

    def open(self, n: int) -> tuple[int, int]:
        first, self.sequences = self.sequences, self.sequences + n
        return first, n

    def leave(self, gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in self.gaps:
                self.gaps[gap] = []
                insort(self.sizes, gap)
            self.gaps[gap].append((first, n))

    def place(self, size: int, n: int, first: int, each: int, offset: int) -> None:
        self.placements.append(Placement(size, self.rank[size], n, first, each, offset))
        self.rank[size] += n
        self.left[size] -= n

    def match_large(self) -> None:
        large = [s for s in self.left if 3 * s > self.capacity]
        for a in reversed(large):
            while n := self.left[a]:
                fit = [b for b in large if a + b <= self.capacity and self.left[b] and (b < a or b == a and n > 1)]
                if not fit:
                    first, n = self.open(n)
                    self.place(a, n, first, 1, 0)
                    self.leave(self.capacity - a, first, n)
                    break
                b = max(fit)
                pairs = n // 2 if a == b else min(n, self.left[b])
                first, _ = self.open(pairs)
                self.place(a, pairs, first, 1, 0)
                self.place(b, pairs, first, 1, a)
                self.leave(self.capacity - a - b, first, pairs)

    def fill(self, size: int, gap: int, first: int, n_sequences: int) -> None:
        """Put pieces of ``size`` into sequences with the same gap, as many as fit, one sequence after another."""
        offset = self.capacity - gap
        each = min(gap // size, self.left[size])
        full = min(n_sequences, self.left[size] // each)
        self.place(size, full * each, first, each, offset)
        self.leave(gap - each * size, first, full)
        rest = min(self.left[size], each) if full < n_sequences else 0
        if rest:
            self.place(size, rest, first + full, rest, offset)
            self.leave(gap - rest * size, first + full, 1)
        used = full + bool(rest)
        self.leave(gap, first + used, n_sequences - used)

    def fit_small(self) -> None:
        for size in sorted((s for s in self.left if 3 * s <= self.capacity), reverse=True):
            while self.left[size]:
                at = bisect_left(self.sizes, size)
                if at == len(self.sizes):
                    needed = -(-self.left[size] // (self.capacity // size))
                    self.fill(size, self.capacity, *self.open(needed))
                    continue
                gap = self.sizes[at]
                first, n = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                    self.sizes.pop(at)
                self.fill(size, gap, first, n)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Placement]:
    """Where the pieces of each length go. ``counts`` has at most ``capacity`` entries whatever the corpus."""
    made = _Plan(counts, capacity)
    made.match_large()
    made.fit_small()
    return made.placements


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, ranks_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pack every row of ``docs`` (doc_id, text; other columns are ignored) into sequences of ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is
    its end token alone. Repeated rows are packed as often as they occur; a row without a doc_id keeps the
    null. An empty table gives no rows. Only the number of pieces of each length reaches the driver.
    ``ranks_path`` is the rank file of the tokenizer's vocabulary, if there is one.
    """
    if tokenizer_path is None:
        tokenizer_path, ranks_path = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)
    pieces = stage(token_pieces(docs, tokenizer_path, ranks_path, capacity, end_id), "token-pieces").df
    counted = stage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts").df
    totals = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    placements = sorted(plan({r["length"]: r["n"] for r in totals}, capacity), key=lambda p: (p.length, p.rank))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shift = 48
    table = np.array([(p.length << shift | p.rank, p.rank, p.sequence, p.each, p.offset, p.length) for p in placements],
                     dtype=np.int64).reshape(-1, 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = table[np.searchsorted(table[:, 0], length << shift | rank, side="right") - 1]
            behind = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(row[:, 2] + behind // row[:, 3]), pa.array(row[:, 4] + behind % row[:, 3] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.drop("part", "nth", "base").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"))
