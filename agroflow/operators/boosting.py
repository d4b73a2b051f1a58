"""Gradient boosting by leaf-wise trees with penalties, own directions for missing values, and patience inside the fit.

Features are cut into at most 255 bins, bin 0 being "missing"; a row is its bins, a byte each, its target and its
prediction so far. Each pass over the rows sums, in the tasks, the gradients per (leaf, feature, bin) and adds the
tasks' sums per leaf and feature after one exchange; the best splits are found there, too, so only a row per leaf
and feature reaches the driver, which opens the leaf with the largest gain next. The leaves that a pass asks for are those which
best-first growth would open as far as gains are known, so a tree takes about as many passes as it is deep, not as
it has leaves. Gradients are whole multiples of a small step: their sums are exact, and a repeated task or another
partitioning gives the same trees.

The loss is squared error. For a leaf with ``n`` rows and gradient sum ``g``, with ``t`` = ``g`` shrunk towards 0 by
``l1``, the score is ``t * t / (n + l2)``, the value ``-t / (n + l2)`` times the step size, and a split's gain the
scores of both sides less that of the leaf.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.sources.workspace import stage

MAX_BINS = 255
#: Trees after which the rows are stored anew with their predictions.
PORTION = 16
#: (leaf, feature, bin) cells that a task adds up at once; a pass asks for as many leaves as fit.
PASS_CELLS = 1 << 22
#: Bits of the fixed-point gradients' sums.
SUM_BITS = 61


@dataclass(frozen=True)
class LeafwiseOptions:
    """Settings of one fit. ``leaves`` and ``depth`` bound a tree, ``row_share`` and ``column_share`` are drawn anew for each."""

    rounds: int = 100
    leaves: int = 31
    depth: int | None = None
    step_size: float = 0.1
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_rows: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    bins: int = MAX_BINS
    seed: int = 42

    def shrunk(self, gradient: float) -> float:
        return math.copysign(max(abs(gradient) - self.l1, 0.0), gradient)

    def value(self, gradient: float, rows: int) -> float:
        return -self.step_size * self.shrunk(gradient) / (rows + self.l2)


@dataclass(frozen=True)
class Binning:
    """Upper edges of each feature's bins; a nominal feature's codes, counted from 0, are bins of their own."""

    edges: tuple[tuple[float, ...], ...]
    nominal: tuple[int, ...] = ()

    def bins(self, values: np.ndarray) -> np.ndarray:
        """A byte for each row and feature. NaN is missing, and so is a code that no bin stands for."""
        out = np.zeros(values.shape, np.uint8)
        for j, edges in enumerate(self.edges):
            column = values[:, j]
            there = ~np.isnan(column)
            if j in self.nominal:
                there &= (column >= 0) & (column < len(edges))
                out[there, j] = column[there].astype(np.int64) + 1
            elif edges:
                out[there, j] = np.minimum(np.searchsorted(np.array(edges), column[there]), len(edges) - 1) + 1
        return out


def fit_binning(rows: DataFrame, width: int, bins: int = MAX_BINS, nominal: Mapping[int, int] | None = None) -> Binning:
    """Bins of about equally many rows from quantile sketches of the vector column ``features``, in one pass.

    ``nominal`` gives the number of codes of features that are category codes; with more codes than bins a feature
    stays a number.
    """
    codes = {j: n for j, n in (nominal or {}).items() if n <= min(bins, MAX_BINS)}
    plain = [j for j in range(width) if j not in codes]
    values = rows.select(vector_to_array("features").alias("v")).select(*[F.nanvl(F.col("v")[j], F.lit(None)).alias(f"c{j}") for j in plain])
    steps = min(bins, MAX_BINS)
    shares = [(i + 1) / steps for i in range(steps)]
    found = values.approxQuantile([f"c{j}" for j in plain], shares, 1 / (4 * steps)) if plain else []
    edges = {j: tuple(sorted(set(q))) for j, q in zip(plain, found)}
    return Binning(tuple(edges[j] if j in edges else tuple(map(float, range(codes[j]))) for j in range(width)), tuple(sorted(codes)))


@dataclass
class Tree:
    """Nodes as arrays; node 0 is the root, a leaf has feature -1. Row b of a node's table says whether bin b goes left."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    goes_left: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        node = np.zeros(len(bins), np.int64)
        open_rows = np.arange(len(bins)) if self.feature[0] >= 0 else np.empty(0, np.int64)
        while len(open_rows):
            at = node[open_rows]
            to_left = self.goes_left[at, bins[open_rows, self.feature[at]]]
            node[open_rows] = np.where(to_left, self.left[at], self.right[at])
            open_rows = open_rows[self.feature[node[open_rows]] >= 0]
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(bins)]


@dataclass(frozen=True)
class Split:
    """A leaf's best split and what goes left; the rest goes right."""

    gain: float
    feature: int
    bins: frozenset[int]
    left_rows: int
    left_sum: int


@dataclass
class _Node:
    rows: int
    total: int
    depth: int
    best: Split | None = None
    known: bool = False
    children: tuple[int, int] | None = None


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The bins of a batch as a table."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _sampled(hashes: np.ndarray, share: float, salt: int) -> np.ndarray:
    """Which rows a tree sees: a hash of the row's hash and the tree's number, so a repeated task sees the same."""
    if share >= 1:
        return np.ones(len(hashes), bool)
    mixed = (hashes.view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


_SUMS = "node int, feature int, bin int, n long, g long"


def _sums(table: DataFrame, pending: list[Tree], grown: Tree, wanted: list[int], columns: list[int], width: int,
                scale: float, options: LeafwiseOptions, salt: int) -> DataFrame:
    """(node, feature, bin, n, g) of the wanted nodes: each task's sums over the training rows that a tree sees."""
    place = np.full(len(grown.feature), -1)
    place[wanted] = np.arange(len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = len(wanted) * 256
        n, g = np.zeros((2, len(columns), cells), np.int64)
        for batch in batches:
            y, f, held, row = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            seen = ~held.astype(bool) & _sampled(row, options.row_share, salt)
            if not seen.any():
                continue
            bins = _matrix(batch.column(4), width)[seen]
            f = f[seen].copy()
            for tree in pending:
                f += tree.predict(bins)
            at = place[grown.leaves(bins)]
            bins, at, gradient = bins[at >= 0], at[at >= 0], np.rint((f - y[seen]) * scale)[at >= 0]
            for i, j in enumerate(columns):
                cell = at * 256 + bins[:, j]
                n[i] += np.bincount(cell, minlength=cells)
                # Whole numbers below 2 ** 53 add up exactly.
                g[i] += np.bincount(cell, gradient, cells).astype(np.int64)
        i, cell = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in ((np.array(wanted)[cell >> 8], pa.int32()), (np.array(columns)[i], pa.int32()), (cell & 255, pa.int32()),
                                         (n[i, cell], pa.int64()), (g[i, cell], pa.int64()))], ["node", "feature", "bin", "n", "g"])

    return table.select("y", "f", "held", "row", "bins").mapInArrow(run, _SUMS)


def best_split(n: np.ndarray, g: np.ndarray, options: LeafwiseOptions, scale: float, nominal: bool = False) -> tuple[float, list[int], int, int] | None:
    """(gain, bins that go left, their rows, their gradient sum) of a leaf's best split on one feature, if any.

    ``n`` and ``g`` are rows and gradient sums (multiples of 1 / ``scale``) per bin. Numbers are split between bins,
    categories after they are put in the order of their mean gradients; missing values, bin 0, are tried on both
    sides. Of equal gains the first cut, then missing on the right wins.
    """
    order = np.flatnonzero(n[1:]) + 1
    if nominal:
        order = order[np.argsort(g[order] / n[order], kind="stable")]
    rows, total = int(n.sum()), int(g.sum())
    # One row for each cut, with missing values on the right and on the left.
    left_rows = np.cumsum(n[order])[:, None] + np.array([0, n[0]])
    left_sum = np.cumsum(g[order])[:, None] + np.array([0, g[0]])

    def score(gradient, count):
        t = np.maximum(np.abs(gradient / scale) - options.l1, 0.0)
        return t * t / np.maximum(count + options.l2, 1e-300)

    gain = score(left_sum, left_rows) + score(total - left_sum, rows - left_rows) - score(np.int64(total), rows)
    least = max(1, options.min_rows)
    allowed = (left_rows >= least) & (rows - left_rows >= least) & (gain > options.min_gain)
    # Without missing values both sides are the same split.
    allowed[:, 1] &= n[0] > 0
    if not allowed.any():
        return None
    at = int(np.where(allowed, gain, -np.inf).argmax())
    cut, missing = divmod(at, 2)
    bins = [0] * missing + order[: cut + 1].tolist()
    return float(gain.flat[at]), bins, int(left_rows.flat[at]), int(left_sum.flat[at])


_SPLITS = "node int, feature int, rows long, total long, gain double, bins array<int>, left_rows long, left_sum long"


def best_splits(sums: DataFrame, options: LeafwiseOptions, scale: float, nominal: Sequence[int] = ()) -> DataFrame:
    """(node, feature, rows, total, gain, bins, left_rows, left_sum): the best split of each node on each feature, nulls
    where it has none. One exchange by node and feature; a task adds up 256 bins for each of its pairs."""
    categories = frozenset(nominal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            node, feature, bin_, n, g = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            pairs, at = np.unique(node.astype(np.int64) << 32 | feature, return_inverse=True)
            cells = np.zeros((len(pairs), 2, 256), np.int64)
            np.add.at(cells, (at, 0, bin_), n)
            np.add.at(cells, (at, 1, bin_), g)
            for pair, values in zip(pairs.tolist(), cells):
                key = pair >> 32, pair & 0xFFFFFFFF
                found[key] = found[key] + values if key in found else values
        out = []
        for (node, feature), (n, g) in sorted(found.items(), key=lambda x: x[0]):
            split = best_split(n, g, options, scale, feature in categories) or (None,) * 4
            out.append((node, feature, int(n.sum()), int(g.sum()), *split))
        if out:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32()), pa.int64(), pa.int64())
            names = ["node", "feature", "rows", "total", "gain", "bins", "left_rows", "left_sum"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return sums.repartition("node", "feature").mapInArrow(run, _SPLITS)


class _Growth:
    """One tree while it grows; the driver keeps a few numbers for each node."""

    def __init__(self, options: LeafwiseOptions, scale: float):
        self.options, self.scale = options, scale
        self.nodes = [_Node(0, 0, 0)]

    def chosen(self) -> tuple[list[int], list[int]]:
        """The nodes that best-first growth opens as far as gains are known, and the leaves whose gains it needs."""
        heap, opened, unknown = [], [], []

        def push(i: int) -> None:
            node = self.nodes[i]
            if not node.known:
                unknown.append(i)
            elif node.best is not None:
                heapq.heappush(heap, (-node.best.gain, i))

        push(0)
        while heap and len(opened) < self.options.leaves - 1:
            i = heapq.heappop(heap)[1]
            opened.append(i)
            self._open(i)
            for child in self.nodes[i].children:
                push(child)
        return opened, unknown

    def _open(self, i: int) -> None:
        node = self.nodes[i]
        if node.children is None:
            split, first = node.best, len(self.nodes)
            self.nodes += [_Node(split.left_rows, split.left_sum, node.depth + 1), _Node(node.rows - split.left_rows, node.total - split.left_sum, node.depth + 1)]
            node.children = (first, first + 1)
            for child in self.nodes[first:]:
                # These cannot be split again.
                deep = self.options.depth is not None and child.depth >= self.options.depth
                child.known = deep or child.rows < 2 * max(1, self.options.min_rows)

    def tree(self, opened: Sequence[int]) -> tuple[Tree, dict[int, int]]:
        """The tree with these nodes open, and the place of each of its nodes."""
        places, queue, inner = {0: 0}, [0], set(opened)
        for i in queue:
            if i in inner:
                for child in self.nodes[i].children:
                    places[child] = len(places)
                    queue.append(child)
        n = len(places)
        made = Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros((n, 256), bool))
        for i, at in places.items():
            node = self.nodes[i]
            made.value[at] = self.options.value(node.total / self.scale, node.rows) if node.rows else 0.0
            if i in inner:
                made.feature[at] = node.best.feature
                made.left[at], made.right[at] = (places[c] for c in node.children)
                made.goes_left[at, list(node.best.bins)] = True
        return made, places


def _grow(table: DataFrame, pending: list[Tree], columns: list[int], binning: Binning, scale: float, options: LeafwiseOptions, salt: int) -> Tree:
    growth = _Growth(options, scale)
    width = len(binning.edges)
    while True:
        opened, unknown = growth.chosen()
        if not unknown:
            return growth.tree(opened)[0]
        tree, places = growth.tree(opened)
        back = {at: i for i, at in places.items()}
        portion = max(1, PASS_CELLS // (256 * len(columns)))
        wanted = sorted(places[i] for i in unknown)[:portion]
        sums = _sums(table, pending, tree, wanted, columns, width, scale, options, salt)
        # A few numbers for each leaf and feature.
        found: dict[int, list] = {}
        for r in best_splits(sums, options, scale, [j for j in binning.nominal if j in columns]).collect():
            found.setdefault(back[r["node"]], []).append(r)
        for i in (back[at] for at in wanted):
            node = growth.nodes[i]
            node.known = True
            if i not in found:
                continue
            node.rows, node.total = found[i][0]["rows"], found[i][0]["total"]
            allowed = [r for r in found[i] if r["gain"] is not None]
            if allowed and not (options.depth is not None and node.depth >= options.depth):
                best = min(allowed, key=lambda r: (-r["gain"], r["feature"]))
                node.best = Split(best["gain"], best["feature"], frozenset(best["bins"]), best["left_rows"], best["left_sum"])


@dataclass(frozen=True)
class LeafwiseModel:
    """Trees over binned features; predicts ``prediction`` from the vector column ``features``, NaN being missing."""

    binning: Binning
    base: float
    trees: tuple[Tree, ...]
    prediction: str = "prediction"
    errors: tuple[float, ...] = field(default=(), compare=False)

    @property
    def getNumTrees(self) -> int:  # noqa: N802 (named like that of the library's models)
        return len(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its predictions, a column."""
        model, width = self, len(self.binning.edges)

        @F.arrow_udf("double")
        def predicted(values: pa.Array) -> pa.Array:
            bins = model.binning.bins(values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            total = np.full(len(bins), model.base)
            for tree in model.trees:
                total += tree.predict(bins)
            return pa.array(total)

        return df.withColumn(self.prediction, predicted(vector_to_array("features")))

    def save(self, path: str) -> None:
        """Trees as a table of their nodes, the rest as one JSON record."""
        spark = SparkSession.active()
        head = {"edges": self.binning.edges, "nominal": self.binning.nominal, "base": self.base, "prediction": self.prediction, "errors": self.errors}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/head")
        nodes = [
            (t, i, int(tree.feature[i]), int(tree.left[i]), int(tree.right[i]), float(tree.value[i]), bytearray(np.packbits(tree.goes_left[i]).tobytes()))
            for t, tree in enumerate(self.trees) for i in range(len(tree.feature))
        ]
        schema = "tree int, node int, feature int, left int, right int, value double, goes_left binary"
        spark.createDataFrame(nodes, schema).write.parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str) -> LeafwiseModel:
        spark = SparkSession.active()
        head = json.loads(spark.read.text(f"{path}/head").first()[0])
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect()
        trees: dict[int, list] = {}
        for r in rows:
            trees.setdefault(r["tree"], []).append(r)
        made = tuple(
            Tree(*(np.array([r[c] for r in nodes]) for c in ("feature", "left", "right", "value")),
                 np.unpackbits(np.frombuffer(b"".join(r["goes_left"] for r in nodes), np.uint8).reshape(-1, 32), axis=1).astype(bool))
            for nodes in trees.values()
        )
        binning = Binning(tuple(map(tuple, head["edges"])), tuple(head["nominal"]))
        return cls(binning, head["base"], made, head["prediction"], tuple(head["errors"]))


def _bin_rows(rows: DataFrame, binning: Binning) -> DataFrame:
    """The rows (y, held, row, values) with their bins in place of the values."""
    width = len(binning.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binning.bins(batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            packed = pa.array([b.tobytes() for b in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), packed], ["y", "f", "held", "row", "bins"])

    return rows.select("y", "f", "held", "row", "values").mapInArrow(run, "y double, f double, held boolean, row long, bins binary")


def _advanced(table: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """The rows with these trees' values added to their predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, f = _matrix(batch.column(4), width), batch.column(1).to_numpy(zero_copy_only=False).copy()
            for tree in trees:
                f += tree.predict(bins)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f), *(batch.column(i) for i in (2, 3, 4))], ["y", "f", "held", "row", "bins"])

    return table.select("y", "f", "held", "row", "bins").mapInArrow(run, "y double, f double, held boolean, row long, bins binary")


def _held_out_errors(table: DataFrame, trees: list[Tree], width: int) -> list[float]:
    """Mean squared error of the held-out rows after each of these trees, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(trees)), 0
        for batch in batches:
            y, f = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (0, 1))
            bins = _matrix(batch.column(4), width)
            n += len(y)
            for i, tree in enumerate(trees):
                f += tree.predict(bins)
                total[i] += ((f - y) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees), dtype=np.int32)), pa.array(total), pa.array([n] * len(trees), pa.int64())], ["i", "e", "n"])

    held = table.filter("held").select("y", "f", "held", "row", "bins").mapInArrow(run, "i int, e double, n long")
    return [r["e"] / r["n"] for r in held.groupBy("i").agg(F.sum("e").alias("e"), F.sum("n").alias("n")).orderBy("i").collect()]


def fit_leafwise(
    train: DataFrame,
    label: str,
    options: LeafwiseOptions,
    held_out: DataFrame | None = None,
    patience: int | None = None,
    prediction: str = "prediction",
    nominal: Mapping[int, int] | None = None,
) -> LeafwiseModel:
    """Boost trees on ``train`` (vector column ``features``, NaN being missing, and ``label``).

    With ``held_out`` and ``patience`` the fit ends once that many rounds brought no smaller error on the held-out
    rows, and the model is cut back to its best round. Rows without a label are an error; a table without rows, too.
    """
    def marked(df: DataFrame, held: bool) -> DataFrame:
        values = vector_to_array("features")
        return df.select(F.col(f"`{label}`").cast("double").alias("y"), F.lit(held).alias("held"), F.xxhash64(values, label).alias("row"), values.alias("values"))

    both = marked(train, False)
    stops = patience is not None and held_out is not None
    if stops:
        both = both.unionByName(marked(held_out, True))
    seen = train.agg(F.count(F.lit(1)).alias("rows"), F.count(F.nanvl(F.col(f"`{label}`").cast("double"), F.lit(None))).alias("labels"),
                     F.avg(label).alias("base"), F.min(label).alias("low"), F.max(label).alias("high"), F.first(F.size(vector_to_array("features"))).alias("width")).first()
    if not seen["rows"] or seen["labels"] < seen["rows"]:
        raise ValueError(f"{seen['rows'] - seen['labels']} of {seen['rows']} training rows have no {label}")
    width, base = seen["width"], float(seen["base"])
    binning = fit_binning(train, width, options.bins, nominal)
    # Gradients stay within a few times the targets' range; their sums must fit in 64 bits.
    spread = max(seen["high"] - base, base - seen["low"]) or 1.0
    scale = 2.0 ** math.floor(min(40, SUM_BITS - math.log2(seen["rows"] + 1)) - math.log2(4 * spread))
    table = stage(_bin_rows(both.withColumn("f", F.lit(base)), binning), "boosting-rows").df
    drawn = np.random.default_rng(options.seed)
    trees: list[Tree] = []
    pending: list[Tree] = []
    errors: list[float] = []
    while len(trees) < options.rounds:
        share = max(1, round(width * options.column_share))
        columns = sorted(drawn.choice(width, share, replace=False).tolist()) if share < width else list(range(width))
        tree = _grow(table, pending, columns, binning, scale, options, options.seed + len(trees) + 1)
        trees.append(tree)
        pending.append(tree)
        due = len(pending) == PORTION or len(trees) == options.rounds
        if stops and (due or len(pending) >= patience):
            errors += _held_out_errors(table, pending, width)
            due = True
            best = int(np.argmin(errors))
            if len(errors) - 1 - best >= patience:
                break
        if due and len(trees) < options.rounds:
            table = stage(_advanced(table, pending, width), "boosting-rows").df
            pending = []
    if stops and errors:
        trees = trees[: _stop(errors, patience)]
    return LeafwiseModel(binning, base, tuple(trees), prediction, tuple(errors))


def _stop(errors: Sequence[float], patience: int) -> int:
    """Rounds up to the best one before ``patience`` rounds without a better one have passed."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1
