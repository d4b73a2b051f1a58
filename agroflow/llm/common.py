"""What the text operators share: reading a table, row identity, batches of Python rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text counts as empty, other columns are left out."""
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def row_keys(docs: DataFrame) -> DataFrame:
    """(row, doc_id, row_hash, text) for every row: the row as it is, and a hash of all its columns.

    What an operator adds stands beside ``row`` and so clashes with no column of the caller's.
    """
    values = [F.to_json(F.struct(f"`{f.name}`")) if _holds_map(f.dataType) else F.col(f"`{f.name}`") for f in docs.schema.fields]
    return docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(*values).alias("row_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _holds_map(kind: T.DataType) -> bool:
    """Whether a type has maps in it, which hash functions refuse."""
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def map_rows(df: DataFrame, fn: Callable[[Iterator[list[tuple]]], Iterable[list[tuple]]], schema: str | T.StructType) -> DataFrame:
    """Run ``fn`` over the batches of each partition, a batch being a list of tuples in the order of the columns.

    ``fn`` is a generator that yields lists of tuples in the order of ``schema``.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(struct)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (list(zip(*(c.to_pylist() for c in b.columns))) for b in it if b.num_rows)
        for out in fn(rows):
            if out:
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return df.mapInArrow(batches, struct)


def hash_filter(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit for each value of the leading ``bits`` bits of the hashes in ``column``: which of them occur.

    Its size is fixed, whatever the table: 2 MB for 24 bits. A hash whose bit is not set does not occur.
    """
    slot = F.shiftrightunsigned(column, 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    words = df.select(F.shiftright(slot, 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << bits - 6, np.uint64)
    for row in words.toLocalIterator():
        out[row["word"]] = np.uint64(row["bits"] & (1 << 64) - 1)
    return out.astype("<u8").view(np.uint8)


def may_occur(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes have their bit set in a filter."""
    width = (len(bits) * 8).bit_length() - 1
    slots = (hashes.view(np.uint64) >> np.uint64(64 - width)).astype(np.int64)
    return bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 > 0


_WORD_BYTES = bytes.maketrans(
    bytes(range(128)),
    bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(128)),
)


def words_of(text: str) -> list[bytes]:
    """The words of a text: runs of ASCII letters (lower-cased), digits and all other characters above ASCII."""
    # Only spaces separate: what else Python takes for white space is above ASCII or was replaced.
    return text.encode().translate(_WORD_BYTES).split()
