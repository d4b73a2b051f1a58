"""Small table edits: drops, fills, dedupe, name clashes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroflow.sources.workspace import StagedTable


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def drop_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must all exist."""
    require_columns(df, columns)
    return df.drop(*columns)


def ensure_columns(df: DataFrame, columns: Iterable[str], value: float) -> DataFrame:
    """Add each missing column with a constant."""
    absent = {c: F.lit(value) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def fill_nulls(df: DataFrame, value, columns: Iterable[str]) -> DataFrame:
    return df.fillna({c: value for c in columns})


def order_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Given columns first, the others after them in their present order."""
    require_columns(df, first)
    return df.select(*first, *[c for c in df.columns if c not in set(first)])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter is applied before the shuffle as well, so a key with very
    many rows leaves at most one row per input task. Rows that are equal in
    ``order_by`` go by all other columns, so the choice never follows arrival.
    """
    named = {c for c in order_by if isinstance(c, str)} | set(keys)
    sortable = [f.name for f in df.schema.fields if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    window = Window.partitionBy(*keys).orderBy(*order_by, *[F.col(f"`{c}`") for c in sortable])
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def head(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def suffix_overlap(
    left: DataFrame, right: DataFrame | StagedTable, keys: Iterable[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> tuple[DataFrame, DataFrame | StagedTable]:
    """Rename non-key columns that both sides have, as a join of the two would need."""
    keys, staged = set(keys), isinstance(right, StagedTable)
    names = set(right.df.columns if staged else right.columns)
    clash = [c for c in left.columns if c in names and c not in keys]
    if not clash:
        return left, right

    def rename(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in clash})

    renamed = right.change(lambda df: rename(df, suffixes[1])) if staged else rename(right, suffixes[1])
    return rename(left, suffixes[0]), renamed
