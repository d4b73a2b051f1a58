"""Target transforms: log1p for flows and yield, Yeo-Johnson for carbon change."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.functions.measures import yeo_johnson, yeo_johnson_inverse
from agroflow.sources.workspace import stage

GRID_POINTS = 25
GRID_LOW, GRID_HIGH = -2.0, 4.0
GRID_PASSES = 4
MAX_SHIFTS = 20


@dataclass(frozen=True)
class TargetScaling:
    """How one target is transformed; ``lam``, ``mean`` and ``std`` only matter for Yeo-Johnson."""

    kind: str
    lam: float = 1.0
    mean: float = 0.0
    std: float = 1.0

    def apply(self, x: Column) -> Column:
        if self.kind == "log1p":
            return F.log1p(x)
        return (yeo_johnson(x, F.lit(self.lam)) - self.mean) / self.std

    def invert(self, y: Column) -> Column:
        if self.kind == "log1p":
            return F.expm1(y)
        return yeo_johnson_inverse(y * self.std + self.mean, F.lit(self.lam))


@dataclass(frozen=True)
class Moments:
    """Rows, mean and summed squared deviations; moments of several parts make those of their union."""

    n: int = 0
    mean: float = 0.0
    deviations: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        return Moments(n, self.mean + apart * other.n / n, self.deviations + other.deviations + apart * apart * self.n * other.n / n)


def _moments(df: DataFrame, powers: Sequence[float]) -> tuple[dict[tuple[int, int], Moments], dict[int, Moments]]:
    """Moments of (part, x) under each candidate power, by part and number of the power, and of the log size, by part.

    One pass: a row is tried under every power and summed at once, before anything is shuffled. The expression stays
    short for any number of powers.
    """
    size = F.log1p(F.abs("x")) * F.signum("x")
    tried = df.select("part", "x", size.alias("size"), F.posexplode(F.array(*map(F.lit, powers))).alias("power", "lam"))
    y = yeo_johnson(F.col("x"), F.col("lam"))
    found = tried.groupBy("part", "power").agg(
        F.count("x").alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("variance"), F.avg("size").alias("size")
    ).collect()
    by_power = {(r["part"], r["power"]): Moments(r["n"], r["mean"], r["variance"] * r["n"]) for r in found}
    return by_power, {r["part"]: Moments(r["n"], r["size"]) for r in found if r["power"] == 0}


class _PowerSearch:
    """Maximum-likelihood power of one set of parts by grid refinement; sees only moments."""

    def __init__(self, parts: Sequence[int]):
        self.parts = list(parts)
        self.low, self.high, self.best = GRID_LOW, GRID_HIGH, 1.0
        self.refinements = self.shifts = 0

    @property
    def done(self) -> bool:
        return self.refinements == GRID_PASSES

    def grid(self) -> list[float]:
        step = (self.high - self.low) / (GRID_POINTS - 1)
        return [self.low + i * step for i in range(GRID_POINTS)]

    def take(self, moments: Mapping[float, Moments], log_size: float) -> None:
        """Move on with the moments under each power of the grid."""
        grid, step = self.grid(), (self.high - self.low) / (GRID_POINTS - 1)

        def score(lam: float) -> float:
            m = moments[lam]
            variance = m.deviations / m.n
            return -0.5 * math.log(variance) + (lam - 1) * log_size if variance > 0 and math.isfinite(variance) else -math.inf

        scores = [score(lam) for lam in grid]
        top = max(range(GRID_POINTS), key=scores.__getitem__)
        if not math.isfinite(scores[top]):
            raise ValueError("no power gives this column a finite likelihood")
        best = grid[top]
        if top in (0, GRID_POINTS - 1):
            if self.shifts == MAX_SHIFTS:
                raise ValueError(f"the likelihood still rises at the power {best:.3g}")
            half = (self.high - self.low) / 2
            self.low, self.high = best - half, best + half
            self.shifts += 1
            return
        left, centre, right = scores[top - 1 : top + 2]
        bend = left - 2 * centre + right
        if bend < 0:
            best += 0.5 * step * (left - right) / bend
        self.refinements += 1
        self.best, self.low, self.high = best, best - step, best + step


def _fit_powers(df: DataFrame, sides: Mapping[int, Sequence[int]]) -> dict[int, TargetScaling]:
    """The scaling of each side, a set of parts of the rows (part, x); a pass serves all sides."""
    df = stage(df.where("x is not null"), "yeo-johnson").df
    ends = {r["part"]: (r["low"], r["high"]) for r in df.groupBy("part").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    out, searches = {}, {}
    for side, parts in sides.items():
        known = [ends[p] for p in parts if p in ends]
        low, high = (min(x[0] for x in known), max(x[1] for x in known)) if known else (None, None)
        if low == high:
            out[side] = TargetScaling("yeo-johnson", 1.0, low or 0.0, 1.0)
        else:
            searches[side] = _PowerSearch(parts)
    while open_searches := [s for s in searches.values() if not s.done]:
        powers = sorted({lam for s in open_searches for lam in s.grid()})
        by_power, sizes = _moments(df, powers)
        for s in open_searches:
            moments = {lam: sum((by_power.get((p, powers.index(lam)), Moments()) for p in s.parts), Moments()) for lam in s.grid()}
            s.take(moments, sum((sizes.get(p, Moments()) for p in s.parts), Moments()).mean)
    if searches:
        powers = sorted({s.best for s in searches.values()})
        by_power, _ = _moments(df, powers)
        for side, s in searches.items():
            m = sum((by_power.get((p, powers.index(s.best)), Moments()) for p in s.parts), Moments())
            out[side] = TargetScaling("yeo-johnson", s.best, m.mean, math.sqrt(m.deviations / m.n) or 1.0)
    return out


def _number(column: str) -> Column:
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None))


def fit_yeo_johnson(df: DataFrame, column: str) -> TargetScaling:
    """Maximum-likelihood power by grid refinement, then mean and population deviation.

    A few passes over one column, written once for them; each returns a few rows.
    NaN counts as missing. A constant or empty column is left as it is; a column
    that is neither must have a power within reach, or the fit is an error.
    """
    return _fit_powers(df.select(F.lit(0).alias("part"), _number(column).alias("x")), {0: [0]})[0]


def fit_target_scalings(df: DataFrame, targets=schemas.TARGETS) -> dict[str, TargetScaling]:
    return {
        t: TargetScaling("log1p") if t in schemas.LOG_TARGETS else fit_yeo_johnson(df, t) for t in targets
    }


def fit_scalings_by_fold(df: DataFrame, targets: Sequence[str], folds: Sequence[int], fold: str = "fold") -> dict[int, dict[str, TargetScaling]]:
    """For each fold, the scalings of the targets fitted on the rows of all other folds.

    Each pass sums once per fold and serves all of them: a training side is the other folds' moments put together.
    """
    out: dict[int, dict[str, TargetScaling]] = {f: {} for f in folds}
    for t in targets:
        if t in schemas.LOG_TARGETS:
            found = dict.fromkeys(folds, TargetScaling("log1p"))
        else:
            rows = df.select(F.col(fold).cast("int").alias("part"), _number(t).alias("x"))
            found = _fit_powers(rows, {f: [g for g in folds if g != f] for f in folds})
        for f in folds:
            out[f][t] = found[f]
    return out


def transform_targets(df: DataFrame, scalings: dict[str, TargetScaling]) -> DataFrame:
    """Add ``<target>_t`` columns."""
    return df.withColumns({f"{t}_t": s.apply(F.nanvl(F.col(t).cast("double"), F.lit(None))) for t, s in scalings.items()})
