"""Category dictionaries: fit, strict apply, save and load.

A dictionary is a table (column, code, value, dtype). Codes follow the natural
order of the column's own type, from 0; a missing value gets code -1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroflow.operators.ranking import ranked
from agroflow.operators.rows import require_columns
from agroflow.operators.skew import BROADCAST_BYTES, lookup_join
from agroflow.sources.workspace import bounded, fresh_path, stage

DICTIONARY_SCHEMA = "column string, code int, value string, dtype string"
MISSING_CODE = -1
#: Unseen values quoted in the error, which names the table of all of them.
SAMPLED_VALUES = 20


def _as_text(column: str, dtype: str):
    """The value as the dictionary would spell it; values that are not of the type stay as they are."""
    return F.coalesce(F.col(column).try_cast(dtype).cast("string"), F.col(column).cast("string"))


def _distinct_values(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """Distinct non-null (column, value, dtype) of many columns in one scan, reduced before the shuffle."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), _as_text(c, t).alias("value"), F.lit(t).alias("dtype"))
            for c, t in dtypes.items()
        ]
    )
    return df.select(F.explode(entries).alias("e")).select("e.*").where(F.col("value").isNotNull()).distinct()


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fit the dictionary of the given columns."""
    require_columns(df, columns)
    dtypes = {c: df.schema[c].dataType.simpleString() for c in columns}
    integers = [c for c in columns if isinstance(df.schema[c].dataType, T.IntegralType)]
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType) and c not in integers]
    # Only the key of the column's own kind is set, so each column sorts by its type.
    keyed = _distinct_values(df, dtypes).withColumns(
        {
            "whole_key": F.when(F.col("column").isin(integers), F.col("value").try_cast("bigint")),
            "number_key": F.when(F.col("column").isin(numbers), F.col("value").try_cast("double")),
        }
    )
    codes = ranked(keyed, ["column"], ["whole_key", "number_key", "value"], "code")
    return codes.select("column", F.col("code").cast("int").alias("code"), "value", "dtype")


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    dictionary.write.mode("overwrite").json(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DICTIONARY_SCHEMA).json(path)


def _dictionary_columns(dictionary: DataFrame) -> dict[str, tuple[str, int, int]]:
    """Column to type, entries and text bytes; one row per encoded column."""
    sizes = dictionary.groupBy("column", "dtype").agg(
        F.count(F.lit(1)).alias("entries"), F.sum(F.octet_length("value")).alias("text")
    )
    return {r["column"]: (r["dtype"], r["entries"], r["text"]) for r in sizes.collect()}


def unknown_categories(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Every (column, value) of ``df`` that the dictionary lacks."""
    dtypes = {c: dtype for c, (dtype, _, _) in _dictionary_columns(dictionary).items()}
    require_columns(df, dtypes)
    seen = _distinct_values(df, dtypes).select("column", "value")
    return lookup_join(seen, dictionary.select("column", "value"), ["column", "value"], "left_anti")


def encode(df: DataFrame, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace the dictionary's columns by their codes; the dictionary must know every value."""
    columns = _dictionary_columns(dictionary)
    names, source = df.columns, df
    for column, (dtype, entries, text) in sorted(columns.items()):
        codes = dictionary.where(F.col("column") == column).select(
            F.col("value").cast(dtype).alias(column), F.col("code").alias(f"_code_{column}")
        )
        sized = bounded(codes, entries)
        sized = replace(sized, bytes=sized.bytes + text)
        # Hot values are counted on the table as it came, not on the joins so far.
        df = lookup_join(df, sized, [column], "left", broadcast_bytes=broadcast_bytes, keys_from=source)
    coded = {c: F.coalesce(f"_code_{c}", F.lit(MISSING_CODE)).cast("int") for c in columns}
    return df.select(*[coded[c].alias(c) if c in coded else F.col(f"`{c}`") for c in names])


def fit_encode(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fit on ``df`` and encode it; returns the encoded table and the dictionary."""
    dictionary = stage(category_dictionary(df, columns), "categories").df
    return encode(df, dictionary), dictionary


def apply_encoding(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Encode new data strictly: a missing column or an unseen value is an error.

    All unseen values are written to the shared folder, and the error says where.
    """
    path = fresh_path(df.sparkSession, "unknown-categories")
    write_dictionary(unknown_categories(df, dictionary), path)
    offending = df.sparkSession.read.schema("column string, value string").json(path)
    totals = {r["column"]: r["count"] for r in offending.groupBy("column").count().collect()}
    if totals:
        sample = [f"{r['column']}={r['value']!r}" for r in offending.orderBy("column", "value").take(SAMPLED_VALUES)]
        raise ValueError(
            f"categories not seen when the dictionary was fitted: {totals} by column, such as {', '.join(sample)}; "
            f"all of them are in {path}"
        )
    return encode(df, dictionary)
