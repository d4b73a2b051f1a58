"""Scalar expressions over measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def aridity_class(index: Column) -> Column:
    """Aridity class as text. Values between two classes, outside all of them or missing are Unknown."""
    # Class limits.
    return (
        F.when(index.between(28, 31.05), "1")
        .when(index.between(31.06, 35), "2")
        .when((index > 35) & (index <= 45), "3")
        .when((index > 45) & (index <= 55), "4")
        .otherwise("Unknown")
    )


def share(part: Column, rest: Column) -> Column:
    """``part / (part + rest)``; 0 where the sum is 0 or anything is missing."""
    return F.coalesce(F.try_divide(part, part + rest), F.lit(0.0))


def null_if(column: Column, sentinel: str) -> Column:
    return F.nullif(column, F.lit(sentinel))


def _branch_power(positive: Column, lam: Column) -> Column:
    return F.when(positive, lam).otherwise(2 - lam)


def yeo_johnson(x: Column, lam: Column) -> Column:
    """Yeo-Johnson power transform (Yeo & Johnson 2000).

    Both branches are one curve of ``log1p(|x|)`` with power ``lam`` above zero
    and ``2 - lam`` below, mirrored by the sign.
    """
    positive = x >= 0
    size = F.log1p(F.abs(x))
    power = _branch_power(positive, lam)
    curve = F.when(power == 0, size).otherwise(F.expm1(power * size) / power)
    return F.when(positive, curve).otherwise(-curve)


def yeo_johnson_inverse(y: Column, lam: Column) -> Column:
    """Inverse of :func:`yeo_johnson`; NULL where ``y`` is outside the transform's range."""
    positive = y >= 0
    size = F.abs(y)
    power = _branch_power(positive, lam)
    log = F.when(power == 0, size).otherwise(F.log1p(power * size) / power)
    return F.when(positive, F.expm1(log)).otherwise(-F.expm1(log))
