"""Training corpus from raw documents: toxic ones go, near copies go, benchmark leaks go, secrets are masked, and what
is left is packed into sequences.

Each stage takes all rows that the one before kept, written as a table and read again. All but the last return the
columns of ``documents``. SQL cannot express the stages (models, fingerprints, alignment, tokens); the tests compare
them with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agroflow.llm.common import read_table
from agroflow.llm.decontamination import drop_contaminated
from agroflow.llm.packing import pack
from agroflow.llm.secrets import redact
from agroflow.llm.simhash import keep_first_copies
from agroflow.llm.toxicity import reject_toxic
from agroflow.sources.workspace import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores as toxic go."""
    return reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    return keep_first_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; every document stays."""
    return redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens get their places in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
