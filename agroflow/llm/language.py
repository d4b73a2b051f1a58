"""Language of pages and documents by Bayesian evidence fusion.

Four pieces of evidence are multiplied: the likelihood of the text under hashed character trigrams, the
language that the markup declares, the suffix of the address, and a prior from the other rows of the same host,
which is smoothed towards its domain and that towards all rows. How far declarations and suffixes can be
trusted is counted from the rows themselves, against what their texts say.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table
from agroflow.llm.urls import host_of
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import stage

BUCKETS = 1 << 16
#: A text counts like so many independent trigrams at most; longer ones say no more about their language.
EFFECTIVE_TRIGRAMS = 40
#: Rows that a domain lends to its hosts, all rows to a domain, and an even spread to declarations and suffixes.
PRIOR_ROWS = 5.0
#: Characters hashed in one step; a bound on memory.
AT_ONCE = 500_000


def _grams(text: str) -> np.ndarray:
    codes = np.frombuffer(f"  {text.lower()} ".encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint32)
    # Digits, punctuation and all white space say nothing.
    codes[codes < 65] = 32
    mixed = (codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77)) + codes[2:] * np.uint32(0xC2B2AE3D)
    return (mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def language_model(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each trigram bucket in each) from all rows of (text, lang); null and empty
    languages teach nothing. The driver gets at most ``BUCKETS`` counts for each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                grams = _grams(text.as_py())
                if lang not in counts:
                    counts[lang] = np.zeros(BUCKETS, np.int64)
                np.add.at(counts[lang], grams, 1)
        for lang, n in counts.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(n[used])], ["lang", "gram", "n"]
            )

    known = labelled.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.lower("lang").alias("lang")).filter("lang != ''")
    seen = known.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in seen})
    counts = np.zeros((len(languages), BUCKETS))
    number = {lang: i for i, lang in enumerate(languages)}
    for lang, gram, n in seen:
        counts[number[lang], gram] = n
    smooth = counts + 0.5
    return languages, np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)


def _log_likelihoods(text: str, model: np.ndarray) -> list[float]:
    """Tempered log likelihoods, the largest of them 0; all 0 for a text without letters."""
    grams = _grams(text)
    grams = grams[grams != _grams("")[0]]
    if not len(grams):
        return [0.0] * len(model)
    sums = sum(model[:, grams[first : first + AT_ONCE]].sum(1, dtype=np.float64) for first in range(0, len(grams), AT_ONCE))
    scaled = sums * min(1.0, EFFECTIVE_TRIGRAMS / len(grams))
    return (scaled - scaled.max()).tolist()


def evidence(rows: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``rows`` with text replaced by ll (log likelihoods in the order of ``languages``) and said, the likeliest
    language of the text (null if the text tells none from another)."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ll = [_log_likelihoods(t.as_py() or "", model) for t in batch.column("text")]
            said = [languages[int(np.argmax(x))] if min(x) < 0 else None for x in ll]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(ll, pa.list_(pa.float64())), pa.array(said, pa.string())], [*kept, "ll", "said"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{fields}, ll array<double>, said string")


def _counts(df: DataFrame, by: str, languages: list[str]) -> DataFrame:
    """Rows of each language for each value of ``by``, as columns n_0, n_1, ..."""
    told = df.filter(F.col(by).isNotNull() & F.col("said").isNotNull())
    return told.groupBy(by).agg(*(F.count_if(F.col("said") == lang).alias(f"{by}_{i}") for i, lang in enumerate(languages)))


def _with_counts(df: DataFrame, by: str, languages: list[str]) -> DataFrame:
    joined = lookup_join(df, stage(_counts(df, by, languages), f"language-{by}"), [by], how="left", spread_by=["row_key"])
    return joined.withColumns({f"{by}_{i}": F.coalesce(f"{by}_{i}", F.lit(0)) for i in range(len(languages))})


def fused(rows: DataFrame, languages: list[str], prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """``rows`` (row_key, ll, said, declared, suffix, host, domain and others) with lang and confidence.

    A row's own text never counts towards its prior or the trust in its declaration. Missing evidence is left
    out; without any, the commonest language wins. Ties go to the first language by name.
    """
    width = len(languages)
    totals = rows.agg(*(F.count_if(F.col("said") == lang) for lang in languages)).first()
    everywhere = [(n + 1) / (sum(totals) + width) for n in totals]
    df = rows
    for by in ("declared", "suffix", "host", "domain"):
        df = _with_counts(df, by, languages)
    others = lambda by, i: F.col(f"{by}_{i}") - F.when(F.col(by).isNotNull() & (F.col("said") == languages[i]), 1).otherwise(0)
    among = lambda by: reduce(lambda a, b: a + b, (others(by, i) for i in range(width)))

    def trust(by: str, i: int) -> Column:
        """How much likelier the value is in a language than anywhere: from counts, smoothed towards no effect."""
        share = (others(by, i) + prior_rows * everywhere[i]) / (among(by) + prior_rows)
        return F.when(F.col(by).isNull(), 0.0).otherwise(F.log(share / everywhere[i]))

    def prior(i: int) -> Column:
        domain = (others("domain", i) + prior_rows * everywhere[i]) / (among("domain") + prior_rows)
        return F.log((others("host", i) + prior_rows * domain) / (among("host") + prior_rows))

    scores = F.array(*(F.col("ll")[i] + trust("declared", i) + trust("suffix", i) + prior(i) for i in range(width)))
    df = df.withColumn("scores", scores)
    best = F.array_max("scores")
    mass = F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("scores")))
    names = F.array(*map(F.lit, languages))
    return df.withColumns({"lang": F.element_at(names, F.array_position("scores", best).cast("int")), "confidence": F.lit(1.0) / mass})


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages as rows of the operator: visible text, declared language, suffix, host and domain of the address."""
    html = F.coalesce(F.col("html"), F.lit(""))
    host = host_of(F.col("url").cast("string"))
    labels = F.split(host, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - (n - 1), F.lit(1)), n), ".")
    declared = F.regexp_extract(F.lower(F.substring_index(html, "<body", 1)), r"""<html[^>]*?\slang\s*=\s*["']?([a-z]+)""", 1)
    empty = lambda c: F.when(c != "", c)
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</\1>|<!--.*?-->|<[^>]*>|&[a-z]+;", " ").alias("text"),
        empty(declared).alias("declared"), empty(last(1)).alias("suffix"), empty(host).alias("host"), empty(last(2)).alias("domain"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as rows of the operator: a source counts as a host, nothing is declared."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.coalesce("text", F.lit("")).alias("text"),
        none.alias("declared"), none.alias("suffix"), F.concat(F.lit("source:"), F.col("source")).alias("host"), none.alias("domain"),
    )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per row of ``rows`` (doc_id, page_id, text, declared, suffix, host, domain): doc_id, page_id, lang,
    confidence, and what the text alone and the declaration say.

    ``labelled`` (text, lang) teaches the text model; without any usable label lang is null. Null and empty texts
    rest on the other evidence. Repeated rows come out as often as they go in.
    """
    languages, model = language_model(labelled)
    out = ["doc_id", "page_id", "lang", "confidence", "said", "declared"]
    if not languages:
        return rows.withColumns({"lang": F.lit(None).cast("string"), "confidence": F.lit(0.0), "said": F.lit(None).cast("string")}).select(*out)
    numbered = rows.withColumn("row_key", F.monotonically_increasing_id())
    told = stage(evidence(numbered, languages, model), "language-evidence").df
    return fused(told, languages).select(*out).withColumnRenamed("said", "text_lang")


def op1_language_fusion(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every page and document; the text model learns from documents that are not held out."""
    docs = read_table(spark, folder, "documents")
    rows = page_rows(read_table(spark, folder, "pages")).unionByName(document_rows(docs))
    found = identify(rows, docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    return found.withColumns({"held_out": held_out(F.col("doc_id")), "confidence": F.round("confidence", 6)})
