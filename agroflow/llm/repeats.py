"""Removal of repeated byte strings by suffix arrays over the places where a repeat is possible.

Every window of ``length`` bytes has one anchor: the first of its ``anchor``-byte strings with the least hash.
Equal windows have equal anchors at equal distances, so a repeat is always between two places that share an
anchor. Anchors that occur once are dropped. Around the others, the text is cut into blocks counted from the
anchor. Different contexts of an anchor are compared by a suffix array of their blocks: suffixes that share
enough blocks may begin a repeat, and only among these the windows themselves are compared. Contexts that occur
twice as a whole are repeats throughout and need only one representative. If an anchor has very many contexts, they
are cut to the windows of either half of their distances from the anchor, and only those are compared that agree on
the bytes which all these windows hold; this goes on as long as too many agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, texts
from agroflow.llm.suffixes import common_prefixes, suffix_array
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import stage

LENGTH, ANCHOR, BLOCK = 400, 128, 32
#: Bytes of a text whose anchors are searched at once; slices overlap, so none is missed.
SLICE = 1 << 20
#: Contexts whose blocks share one suffix array, and the contexts of one anchor that are compared together at most;
#: those of more crowded anchors are told apart by the bytes around the anchor first.
BATCH_CONTEXTS, CROWDED = 1500, 1500

_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFFFFFFFF00000000)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _M1
    return h ^ (h >> np.uint64(29))


def rolling_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes along the last axis."""
    n = data.shape[-1]
    power, inverse = _powers(SLICE)
    sums = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * inverse[:n], axis=-1, out=sums[..., 1:])
    return _mixed((sums[..., size:] - sums[..., :-size]) * power[: n - size + 1])


def anchors(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of all windows of a text."""
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for first in range(0, max(1, len(data) - length + 1), SLICE - length + 1):
        part = data[first : first + SLICE]
        if len(part) < length:
            break
        h = rolling_hashes(part, anchor)
        # The place in the low half: of equal hashes, the first is the least.
        least = (h & _M2) | np.arange(len(h), dtype=np.uint64)
        size, wanted = 1, length - anchor + 1
        while 2 * size <= wanted:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < wanted:
            least = np.minimum(least[: size - wanted], least[wanted - size :])
        found = np.unique((least & ~_M2).astype(np.int64))
        places.append(found + first)
        hashes.append(h[found])
    at = np.concatenate(places)
    at, one = np.unique(at, return_index=True)
    return at, np.concatenate(hashes)[one]


def _context(place: int, n: int, length: int, anchor: int) -> tuple[int, int]:
    """All windows that hold the anchor lie between these bytes."""
    return max(0, place - (length - anchor)), min(n, place + length)


def anchor_table(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """(id, text_hash, place, anchor_hash, context_hash) for every anchor of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 500) for b in batches for first in range(0, b.num_rows, 500)):
            columns = [[], [], [], [], []]
            for id_, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_py().encode()
                if len(raw) < length:
                    continue
                at, h = anchors(np.frombuffer(raw, np.uint8), length, anchor)
                contexts = np.empty(len(at), np.uint64)
                for k, place in enumerate(at.tolist()):
                    low, high = _context(place, len(raw), length, anchor)
                    contexts[k] = xxhash.xxh64_intdigest(raw[low:high], place - low)
                for column, values in zip(columns, (np.full(len(at), id_, np.int64), np.full(len(at), text_hash, np.int64), at, h.view(np.int64), contexts.view(np.int64))):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in columns], ["id", "text_hash", "place", "anchor_hash", "context_hash"]
                )

    return rows.select("id", "text_hash", "text").mapInArrow(
        run, "id long, text_hash long, place long, anchor_hash long, context_hash long"
    )


def _cut_contexts(texts_with_places: DataFrame, length: int, anchor: int) -> DataFrame:
    """The bytes of the wanted contexts (``wanted`` lists place, anchor_hash, context_hash of a text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1)):
                raw, out = text.as_py().encode(), []
                for w in wanted.as_py():
                    low, high = _context(w["place"], len(raw), length, anchor)
                    out.append((w["anchor_hash"], w["context_hash"], w["place"] - low, raw[low:high]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    ["anchor_hash", "context_hash", "behind", "bytes"],
                )

    return texts_with_places.select("text", "wanted").mapInArrow(
        run, "anchor_hash long, context_hash long, behind int, bytes binary"
    )


def _window_hashes(behind: np.ndarray, parts: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, present) of the windows of each context: one column for each distance of the anchor from the
    start of the window, from 0 on."""
    left, width = length - anchor, 2 * length - anchor
    hashes = np.zeros((len(parts), left + 1), np.uint64)
    for first in range(0, len(parts), 256):
        block = np.zeros((min(256, len(parts) - first), width), np.uint8)
        for row, (b, raw) in enumerate(zip(behind[first : first + 256].tolist(), parts[first : first + 256])):
            block[row, left - b : left - b + len(raw)] = np.frombuffer(raw, np.uint8)
        hashes[first : first + 256] = rolling_hashes(block, length)[:, ::-1]
    ahead = np.fromiter(map(len, parts), np.int64, len(parts)) - behind
    distance = np.arange(left + 1)
    return hashes, (distance <= behind[:, None]) & (length - distance <= ahead[:, None])


def _runs(flags: np.ndarray) -> list[list[int]]:
    """[first, last] of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [[a, b - 1] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def repeated_windows(group: np.ndarray, behind: np.ndarray, parts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR, block: int = BLOCK) -> np.ndarray:
    """Which windows of the contexts are also in another context of the same group, as flags by distance of the
    anchor. ``group`` numbers the anchors, ``behind`` is the anchor's place in each context."""
    left = length - anchor
    hashes, present = _window_hashes(behind, parts, length, anchor)
    ahead = np.fromiter(map(len, parts), np.int64, len(parts)) - behind
    # Whole blocks before and after each anchor, and what they hold.
    before, after = behind // block, ahead // block
    count = before + after
    owner = np.repeat(np.arange(len(parts)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) - before[owner]
    joined = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    at = starts[owner] + behind[owner] + number * block
    content = np.zeros(len(owner), np.uint64)
    power = _powers(SLICE)[0][:block]
    for first in range(0, len(owner), 1 << 13):
        cells = joined[at[first : first + (1 << 13), None] + np.arange(block)]
        content[first : first + (1 << 13)] = _mixed(((cells.astype(np.uint64) + np.uint64(1)) * power).sum(1, dtype=np.uint64))
    where = (group[owner].astype(np.uint64) << np.uint64(8)) + (number + 128).astype(np.uint64)
    _, symbols = np.unique(_mixed(_mixed(where) + content), return_inverse=True)
    symbols = symbols.tolist()
    # A window holds at least so many whole blocks after its first block boundary.
    needed = (length - block + 1) // block
    array = suffix_array(symbols)
    shared = np.array(common_prefixes(symbols, array, needed), np.int64) >= needed
    interval = np.cumsum(~shared)
    alone = ~shared & ~np.append(shared[1:], False)
    suffix, interval = np.array(array, np.int64)[~alone], interval[~alone]
    flags = np.zeros((len(parts), left + 1), bool)
    # Windows that begin less than a block before such a suffix.
    ahead_of = -number[suffix] * block
    for d in range(block):
        distance = ahead_of + d
        fits = (distance >= 0) & (distance <= left)
        rows, columns, sets = owner[suffix[fits]], distance[fits], interval[fits]
        fits = present[rows, columns]
        rows, columns, sets = rows[fits], columns[fits], sets[fits]
        keys = hashes[rows, columns]
        order = np.lexsort((keys, sets))
        same = (keys[order][1:] == keys[order][:-1]) & (sets[order][1:] == sets[order][:-1])
        twice = np.append(same, False) | np.insert(same, 0, False) if len(order) else np.empty(0, bool)
        flags[rows[order[twice]], columns[order[twice]]] = True
    return flags


_SPANS = "anchor_hash long, context_hash long, spans array<array<int>>"


def _compared(contexts: DataFrame, length: int, anchor: int, block: int) -> DataFrame:
    """(anchor_hash, context_hash, spans) of the contexts with repeats in their group (``contexts`` has group_hash,
    context_hash, behind, bytes and anchor_hash)."""

    def spans(rows: list[tuple]) -> pa.RecordBatch | None:
        key = np.array([r[0] for r in rows], np.int64)
        group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        flags = repeated_windows(group, np.array([r[2] for r in rows], np.int64), [r[3] for r in rows], length, anchor, block)
        found = [(rows[i][4], rows[i][1], _runs(flags[i])) for i in np.flatnonzero(flags.any(1))]
        if not found:
            return None
        types = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["anchor_hash", "context_hash", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                # Equal rows of the table give a context more than once.
                if held and row[:2] == held[-1][:2]:
                    continue
                # Groups stay whole.
                if len(held) >= BATCH_CONTEXTS and row[0] != held[-1][0]:
                    if (out := spans(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if held and (out := spans(held)) is not None:
            yield out

    rows = contexts.select("group_hash", "context_hash", "behind", "bytes", "anchor_hash")
    return rows.repartition("group_hash").sortWithinPartitions("group_hash", "context_hash").mapInArrow(run, _SPANS)


_HALF = "anchor_hash long, context_hash long, low int, high int, behind int, bytes binary, first int, last int, group_hash long, class_hash long"


def _halved(contexts: DataFrame, length: int) -> DataFrame:
    """The contexts cut to the windows whose distance lies in either half of low to high, where they have any: those
    from first to last. Windows that are equal have an equal group_hash, that of the bytes which all windows of the
    half hold; an equal class_hash is that of all bytes of the half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 500) for b in batches for first in range(0, b.num_rows, 500)):
            out = []
            for anchor_hash, context_hash, low, high, behind, raw in zip(*(c.to_pylist() for c in batch.columns)):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    first, last = max(a, length - len(raw) + behind), min(b, behind)
                    if first > last:
                        continue
                    cut = raw[behind - last : behind + length - a]
                    group = xxhash.xxh64_intdigest(raw[behind - a : behind + length - b], a << 32 | b)
                    hashes = np.array([group, xxhash.xxh64_intdigest(cut, last)], np.uint64).view(np.int64).tolist()
                    out.append((anchor_hash, context_hash, a, b, last, cut, first, last, *hashes))
            if out:
                types = (pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.binary(), *[pa.int32()] * 2, pa.int64(), pa.int64())
                names = [c.split()[0] for c in _HALF.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return contexts.select("anchor_hash", "context_hash", "low", "high", "behind", "bytes").mapInArrow(run, _HALF)


def _divided(contexts: DataFrame, length: int, anchor: int, block: int, crowded: int) -> DataFrame:
    """The same as ``_compared`` for anchors with too many contexts for one task; no context comes twice. Each round
    halves the distances of the groups that are still crowded; with one distance left, a group is one window."""
    found = []
    rows = contexts.withColumns({"low": F.lit(0), "high": F.lit(length - anchor)})
    while True:
        halves = stage(_halved(rows, length), "crowded-halves").df
        key = ["group_hash", "class_hash"]
        classes = stage(halves.groupBy(*key).agg(F.min("context_hash").alias("context_hash"), F.count(F.lit(1)).alias("n")), "crowded-classes").df
        # Halves that occur twice as a whole are repeats throughout and need only one representative, too.
        whole = lookup_join(halves, stage(classes.filter("n > 1").select(*key), "crowded-repeats"), key, how="left_semi", spread_by=["context_hash"])
        found.append(whole.select("anchor_hash", "context_hash", F.array(F.array("first", "last")).alias("spans")))
        several = stage(classes.groupBy("group_hash").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1"), "crowded-groups")
        one_each = stage(lookup_join(classes.drop("class_hash", "n"), several, ["group_hash"], spread_by=["context_hash"]), "crowded-firsts")
        rows = lookup_join(halves, one_each, ["group_hash", "context_hash"], spread_by=["context_hash"])
        found.append(_compared(rows.filter(F.col("classes") <= crowded), length, anchor, block))
        if not several.df.filter(F.col("classes") > crowded).head(1):
            break
        rows = rows.filter(F.col("classes") > crowded)
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy("anchor_hash", "context_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _merged(bytes_of: list[list[int]]) -> list[int]:
    """Flat [start, end, start, end, ...] of the union of intervals."""
    out: list[int] = []
    for start, end in sorted(bytes_of):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def covered(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block: int = BLOCK, crowded: int = CROWDED) -> DataFrame:
    """(id, text_hash, runs): the runs of bytes of each text that lie in a string of ``length`` bytes that also
    starts elsewhere, flat as start, end, start, end. ``rows`` has id, text_hash and text; no id is null."""
    found = stage(anchor_table(rows, length, anchor), "anchors").df
    shared = stage(found.groupBy("anchor_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "shared-anchors")
    live = stage(lookup_join(found, shared, ["anchor_hash"], how="left_semi", spread_by=["id", "place"]), "live-anchors").df
    first = F.min(F.struct("id", "text_hash", "place"))
    contexts = stage(live.groupBy("anchor_hash", "context_hash").agg(F.count(F.lit(1)).alias("n"), first.alias("at")), "anchor-contexts").df
    several = contexts.groupBy("anchor_hash").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1")
    mixed = lookup_join(contexts, stage(several, "mixed-anchors"), ["anchor_hash"], spread_by=["context_hash"])
    listed = F.collect_list(F.struct("at.place", "anchor_hash", "context_hash")).alias("wanted")
    wanted = mixed.groupBy("at.id", "at.text_hash").agg(listed)
    # Both tables grow with the corpus, so neither is broadcast.
    cut = _cut_contexts(rows.join(wanted, ["id", "text_hash"]), length, anchor)
    sized = stage(mixed.groupBy("anchor_hash").agg(F.max("contexts").alias("contexts")).filter(F.col("contexts") > crowded).drop("contexts"), "crowded-anchors")
    if sized.rows:
        # Both sides of the split read it, so the texts are joined once.
        cut = stage(cut, "cut-contexts").df
    usual = lookup_join(cut, sized, ["anchor_hash"], how="left_anti", spread_by=["context_hash"]) if sized.rows else cut
    compared = _compared(usual.withColumn("group_hash", F.col("anchor_hash")), length, anchor, block)
    if sized.rows:
        hot = lookup_join(cut, sized, ["anchor_hash"], how="left_semi", spread_by=["context_hash"]).dropDuplicates(["anchor_hash", "context_hash"])
        compared = compared.unionByName(_divided(hot, length, anchor, block, crowded))
    whole = contexts.filter("n > 1").select(
        "anchor_hash", "context_hash", F.lit(None).cast("array<array<int>>").alias("spans")
    )
    # A context that occurs twice is covered throughout, whatever the comparison found.
    partial = compared.join(whole.select("anchor_hash", "context_hash"), ["anchor_hash", "context_hash"], "left_anti")
    known = stage(partial.unionByName(whole), "repeat-spans").df
    # Adaptive execution splits the partitions of contexts with very many copies.
    hits = live.join(known, ["anchor_hash", "context_hash"])

    def bytes_covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 500) for b in batches for first in range(0, b.num_rows, 500)):
            out = []
            for n, hit in zip(batch.column(2).to_pylist(), batch.column(3)):
                parts = []
                for h in hit.as_py():
                    place = h["place"]
                    if h["spans"] is None:
                        parts.append(_context(place, n, length, anchor))
                    else:
                        parts += [(place - b, place - a + length) for a, b in h["spans"]]
                out.append(_merged(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["id", "text_hash", "runs"])

    sizes = stage(rows.select("id", "text_hash", F.octet_length("text").cast("long").alias("size")).filter(F.col("size") >= length).distinct(), "text-sizes")
    per_text = hits.groupBy("id", "text_hash").agg(F.collect_list(F.struct("place", "spans")).alias("hits"))
    sized_texts = per_text.join(sizes.df, ["id", "text_hash"]).select("id", "text_hash", "size", "hits")
    return sized_texts.mapInArrow(bytes_covered, "id long, text_hash long, runs array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, id, text_hash, text): every row with a key of its doc_id and text that is never null."""
    missing = F.col("doc_id").isNull()
    text_hash: Column = F.when(missing, F.xxhash64("text", F.lit("no id"))).otherwise(F.xxhash64("text"))
    return texts(docs).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), text_hash.alias("text_hash"), "text")


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block: int = BLOCK, crowded: int = CROWDED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and kept, the bytes that stay.

    A byte is removed if it lies in a string of ``length`` bytes that also starts elsewhere, in the same text or
    another, judged on the input; equal rows repeat each other. Null and empty texts have no bytes; texts shorter
    than ``length`` stay whole. An empty table gives no rows.
    """
    rows = keyed(docs)
    runs = stage(covered(rows, length, anchor, block, crowded), "covered-runs")
    joined = lookup_join(rows, runs, ["id", "text_hash"], how="left", spread_by=["id", "text_hash"]).select("doc_id", "text", "runs")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part, out = batch.slice(first, 256), []
                for doc_id, text, spans in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()):
                    raw, at, kept = text.as_py().encode(), 0, []
                    spans = spans or []
                    for start, end in zip(spans[::2], spans[1::2]):
                        kept.append(raw[at:start])
                        at = end
                    rest = b"".join([*kept, raw[at:]])
                    out.append((doc_id, len(raw), len(raw) - len(rest), len(spans) // 2, hashlib.sha256(rest).hexdigest(), rest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op3_lyndon_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents")).drop("kept")
