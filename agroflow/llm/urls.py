"""URL filter: rules first, then naive Bayes over segmented host words and path tokens.

Host names are split into words by a Viterbi search under word frequencies of the pages themselves. The
substrings of a name are joined to the word counts, so that no word list travels to the tasks. Naive Bayes
learns from pages whose host holds a seed word, over hashed tokens without the seeds, so its model has a fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import ascii_lower, read_table
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import StagedTable, stage

#: (verdict, host, path): the rule fits the host and its subdomains under the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words that mark a host as unwanted when naive Bayes is fitted.
SEED_WORDS = ("ads", "adult", "bet", "bets", "casino", "gambling", "jackpot", "loan", "loans", "lottery", "malware",
              "pharmacy", "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "track", "tracker", "warez", "xxx")
LONGEST_WORD = 20
#: Different labels beside a host's label that make it a unit.
LABEL_NEIGHBOURS = 5
#: Odds of block that a seed word itself brings.
SEED_ODDS = 20.0
#: Hash buckets of the naive Bayes tokens; bounds the model.
BUCKETS = 1 << 18
BLOCK_ABOVE = 0.5


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next slash, question mark, hash or end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _visible_words(pages: DataFrame) -> DataFrame:
    """Runs of letters a-z in the pages' visible text, and in host names whose parts are set apart by hyphens.

    A name that is one run of letters is no evidence that it is one word, so it is not counted.
    """
    # Tags, scripts, entities and dotted names are no words of the text.
    marks = r"(?s)<(script|style)[^>]*>.*?</\1>|<[^>]*>|&#?[A-Za-z0-9]+;|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
    visible = F.regexp_replace(F.coalesce("html", F.lit("")), marks, " ")
    body = F.regexp_extract_all(ascii_lower(visible), F.lit("[a-z]+"), F.lit(0))
    labels = F.filter(F.split(host_of(F.col("url")), r"\."), lambda x: F.contains(x, F.lit("-")))
    parts = F.flatten(F.transform(labels, lambda x: F.regexp_extract_all(x, F.lit("[a-z]+"), F.lit(0))))
    return pages.select(F.explode(F.concat(body, parts)).alias("word"))


def _label_words(pages: DataFrame, neighbours: int = LABEL_NEIGHBOURS) -> DataFrame:
    """(word, n): labels of host names that are units of their own, each host counted once.

    The last label is one; any other if it stands beside at least so many different labels: ``www`` and a common
    domain do, a site's own name beside ``www`` and ``m`` does not.
    """
    hosts = pages.select(host_of(F.col("url").cast("string")).alias("host")).distinct()
    labels = hosts.select(F.split("host", r"\.").alias("labels")).select("labels", F.posexplode("labels").alias("at", "word"))
    last = labels.filter(F.col("at") == F.size("labels") - 1).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    beside = labels.filter(F.col("at") < F.size("labels") - 1).select("word", F.explode(F.array(
        F.struct(F.lit(-1).alias("side"), F.get("labels", F.col("at") - 1).alias("other")),
        F.struct(F.lit(1).alias("side"), F.get("labels", F.col("at") + 1).alias("other")),
    )).alias("x")).select("word", "x.*").filter("other is not null").distinct()
    inner = beside.groupBy("word", "side").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= neighbours)
    return last.unionByName(inner.groupBy("word").agg(F.max("n").alias("n"))).filter(F.col("word").rlike("^[a-z]+$"))


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) of the words that names are split into."""
    seen = _visible_words(pages).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    both = seen.unionByName(_label_words(pages)).filter(F.length("word") <= LONGEST_WORD)
    return both.groupBy("word").agg(F.sum("n").alias("n"))


def segment(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest split of a name; ``known`` counts its substrings by (start, end).

    An unknown word of k letters has probability 10 ** -k / total. Among equally likely splits the one with
    the longest last words wins.
    """
    best = [0.0] + [-math.inf] * len(name)
    cut = [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            n = known.get((start, end))
            p = math.log(n / total) if n else -math.log(total) - (end - start) * math.log(10)
            if best[start] + p > best[end]:
                best[end], cut[end] = best[start] + p, start
    words, end = [], len(name)
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segmented(names: DataFrame, counts: StagedTable, total: int) -> DataFrame:
    """(name, words) for the distinct values of ``names.name``, runs of letters a-z."""
    size = F.length("name")
    places = F.flatten(F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda a: F.transform(F.sequence(a + 1, F.least(size, a + LONGEST_WORD)), lambda b: F.struct(a.alias("a"), b.alias("b"))),
    ))
    distinct = names.filter(size > 0).select("name").distinct()
    spans = distinct.select("name", F.explode(places).alias("at")).select(
        "name", "at.a", "at.b", F.expr("substring(name, at.a + 1, at.b - at.a)").alias("word")
    )
    # Single letters are in every name.
    met = lookup_join(spans, counts, ["word"], "left", spread_by=["name", "a", "b"]).groupBy("name").agg(
        F.collect_list(F.when(F.col("n").isNotNull(), F.struct("a", "b", "n"))).alias("known")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            words = [
                segment(name, {(k["a"], k["b"]): k["n"] for k in known}, total)
                for name, known in zip(names, batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return met.mapInArrow(run, "name string, words array<string>")


def host_words(hosts: DataFrame, counts: StagedTable, total: int) -> DataFrame:
    """(host, host_tokens) for each distinct host: its runs of letters, each split into words."""
    runs = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))).alias("nth", "name"))
    split = lookup_join(runs, stage(segmented(runs, counts, total), "segmented-names"), ["name"], spread_by=["host", "nth"])
    ordered = F.array_sort(F.collect_list(F.struct("nth", "words")))
    per_host = split.groupBy("host").agg(F.flatten(F.transform(ordered, lambda x: x["words"])).alias("host_tokens"))
    return hosts.join(per_host, "host", "left").select("host", F.coalesce("host_tokens", F.array().cast("array<string>")).alias("host_tokens"))


def path_tokens(path: Column) -> Column:
    """Parts of a path between marks, lower-cased; every number is the token 0."""
    parts = F.filter(F.split(ascii_lower(path), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")
    return F.transform(parts, lambda x: F.concat(F.lit("/"), F.regexp_replace(x, "[0-9]+", "0")))


def _buckets(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))


def fitted(pages: DataFrame, seeds: Sequence[str] = SEED_WORDS) -> tuple[float, np.ndarray]:
    """(prior, weights) of naive Bayes as log odds of block; at most two counts per bucket reach the driver.

    Pages whose host holds a seed word are the examples to block. Seeds are left out of what is learned, or the model
    would learn the list and nothing else; each brings its own fixed odds when a page is judged.
    """
    listed = F.array(*map(F.lit, seeds)).cast("array<string>")
    spam = F.arrays_overlap("host_tokens", listed)
    rest = F.concat(F.array_except("host_tokens", listed), path_tokens(F.col("path")))
    of_class = pages.select(_buckets(rest).alias("buckets"), spam.alias("spam"))
    totals = {r["spam"]: r["n"] for r in of_class.groupBy("spam").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.zeros((2, BUCKETS))
    seen = of_class.select("spam", F.explode("buckets").alias("bucket")).groupBy("spam", "bucket").agg(F.count(F.lit(1)).alias("n"))
    for r in seen.collect():
        counts[int(r["spam"]), r["bucket"]] = r["n"]
    used = max(1, np.count_nonzero(counts.sum(0)))
    smooth = (counts + 1) / (counts.sum(1, keepdims=True) + used)
    prior = math.log((totals.get(True, 0) + 1) / (totals.get(False, 0) + 1))
    weights = np.log(smooth[1]) - np.log(smooth[0])
    if seeds:
        own = pages.sparkSession.createDataFrame([(list(seeds),)], "seeds array<string>").select(_buckets(F.col("seeds")).alias("b")).first()["b"]
        weights[own] = math.log(SEED_ODDS) - prior
    return prior, weights


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = SEED_WORDS) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html; other columns are ignored): page_id, host, path, rule,
    verdict, and what naive Bayes says (block_score, 0 to 1) over host_words.

    The longest rule that fits decides; without one, a score above one half blocks. A null url, or one without
    ``://``, has an empty host and path and is judged by the prior alone. Repeated rows come out as often as
    they go in; an empty table gives no rows.
    """
    counts = stage(word_counts(pages), "url-words")
    total = counts.df.agg(F.sum("n")).first()[0] or 1
    url = F.col("url").cast("string")
    parsed = stage(
        pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")), "url-parts"
    ).df
    hosts = stage(host_words(parsed.select("host").distinct(), counts, total), "url-hosts")
    tokens = F.concat("host_tokens", path_tokens(F.col("path")))
    full = lookup_join(parsed, hosts, ["host"], spread_by=["page_id", "path"]).withColumn("buckets", _buckets(tokens))
    prior, weights = fitted(full, seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            flat = weights[lists.flatten().to_numpy(zero_copy_only=False)]
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            sums = np.r_[0.0, np.cumsum(flat)]
            odds = prior + sums[ends] - sums[np.r_[0, ends[:-1]].astype(int)]
            score = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "host", "path", "host_tokens")), pa.array(score)],
                ["page_id", "host", "path", "host_words", "block_score"],
            )

    scored = full.select("page_id", "host", "path", "host_tokens", "buckets").mapInArrow(
        run, "page_id long, host string, path string, host_words array<string>, block_score double"
    )
    rule = best_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("block_score") > BLOCK_ABOVE, "block").otherwise("allow")
    return scored.withColumn("of", rule).select(
        "page_id", "host", "path", "of.rule", F.coalesce("of.verdict", method).alias("verdict"),
        F.array_join("host_words", " ").alias("host_words"), F.round("block_score", 6).alias("block_score"),
    )


def op10_url_words(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read_table(spark, folder, "pages"))
