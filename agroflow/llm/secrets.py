"""Secrets in text by multipart linking, with DataFrame functions only.

Base patterns always report. Weak candidates (short or unlabelled secrets, account names, endpoints) report
only if the parts that complete them stand within a scope of the text around them. The parts are joined on
intervals: every part is dealt to the cells of the text it touches, and parts of a common cell are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, row_keys, texts
from agroflow.operators.skew import lookup_join
from agroflow.sources.workspace import stage

#: Code points between two parts of one credential at most.
SCOPE = 200
ASSIGN_LENGTH = 6

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is long enough as a whole: the same matches as runs of any length, short ones dropped.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: An account or key name beside an assignment sign.
IDENT = r"""(?i:access_?key_?id|access_?key|client_?id|account|username|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
#: A long run of letters and digits that no label introduces.
OPAQUE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"""(?i:https?|ftp|postgres|mysql|mongodb|redis|amqp|s3)://[^\x09-\x0D\x20"'<>]+|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}"""

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "ident", "weak", "endpoint")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "ident": IDENT, "weak": OPAQUE, "endpoint": ENDPOINT}
_SOME_BASE = "|".join((ASSIGN, ACCESS, HEX))


def _matches(text: Column, kind: str) -> Column:
    """Matches of a pattern as (kind, length of the text before it, length, value) in their order."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    return F.zip_with(
        between, found,
        lambda gap, value: F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(value).alias("size"), value.alias("value")),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """(uid, kind, start, end) of all matches that pass their kind's test; ``rows`` has uid and matches."""
    one = rows.select("uid", F.explode("matches").alias("of")).select("uid", F.posexplode("of").alias("nth", "m"))
    seen = Window.partitionBy("uid", "m.kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(seen)
    value = F.col("m.value")
    kind = F.col("m.kind")
    keep = (kind != "weak") | (value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]"))
    short = (kind == "assign") & (F.length(F.regexp_extract(value, ASSIGN, 2)) < ASSIGN_LENGTH)
    # A labelled value that is too short for the base pattern is a weak secret.
    return (
        one.withColumn("end", end)
        .filter(keep)
        .select("uid", F.when(short, F.lit("weak")).otherwise(kind).alias("kind"), (F.col("end") - F.col("m.size")).alias("start"), "end")
    )


def _is_base(kind: Column) -> Column:
    return kind.isin(*BASE_KINDS)


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak candidates outside all base spans whose complements stand within ``scope``."""
    upto = Window.partitionBy("uid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("uid").orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    base = _is_base(F.col("kind"))
    clear = (
        parts.withColumn("before", F.max(F.when(base, F.col("end"))).over(upto))
        .withColumn("after", F.min(F.when(base, F.col("start"))).over(onward))
        .filter(base | ((F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))))
        .drop("before", "after")
    )
    cells = lambda first, last: F.explode(F.sequence(F.expr(f"({first}) div {scope}"), F.expr(f"({last}) div {scope}")))
    weak = clear.filter(~base).withColumn("cell", cells(f"greatest(start - {scope}, 0)", f"end + {scope}"))
    others = clear.filter("kind != 'endpoint'").select(
        "uid", cells("start", "end").alias("cell"), F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("kind").isin("access", "ident").alias("names")
    )
    near = (F.col("o_start") - F.col("end") <= scope) & (F.col("start") - F.col("o_end") <= scope)
    met = weak.join(others, ["uid", "cell"]).filter(near).groupBy("uid", "kind", "start", "end").agg(
        F.bool_or("names").alias("name"), F.bool_or(~F.col("names")).alias("secret")
    )
    complete = (F.col("kind") == "ident") & F.col("secret") | (F.col("kind") == "weak") & F.col("name") | F.col("name") & F.col("secret")
    return met.filter(complete).select("uid", "kind", "start", "end")


def scan(docs: DataFrame, scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row of ``docs`` as (uid, doc_id, text_hash), and its spans as (uid, kind, start, end).

    Positions count code points, the end is exclusive. Null and empty texts have no spans. Repeated rows
    have spans each; other columns are ignored. Both tables are in the shared folder; neither holds a text.
    """
    text = F.col("text")
    worth = text.rlike(_SOME_BASE) | (text.rlike(IDENT) & text.rlike(OPAQUE))
    found = stage(
        texts(docs).select(
            F.monotonically_increasing_id().alias("uid"), "doc_id", F.xxhash64("text").alias("text_hash"),
            F.when(worth, F.array(*(_matches(text, kind) for kind in KINDS))).alias("matches"),
        ),
        "secret-parts",
    ).df
    parts = stage(_placed(found.filter("matches is not null").select("uid", "matches")), "secret-places").df
    spans = parts.filter(_is_base(F.col("kind"))).unionByName(_linked(parts, scope))
    return found.drop("matches"), spans


def _listed(spans: Column) -> Column:
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: counts of the base spans, a digest of them, and all spans as text."""
    rows, spans = scan(docs, scope)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    of = F.struct("start", order.alias("order"), "end", "kind")
    base = _is_base(F.col("kind"))
    per_row = spans.groupBy("uid").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE_KINDS),
        _listed(F.collect_list(F.when(base, of))).alias("base"),
        _listed(F.collect_list(of)).alias("spans"),
    )
    return rows.join(per_row, "uid", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[REDACTED]", scope: int = SCOPE, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with every span replaced by ``mask`` and ``n_chars`` (if there) counted anew; no row is dropped.

    Only rows with spans are looked up: their table is broadcast if its measured size is below
    ``broadcast_bytes`` and joined by shuffle otherwise. Overlapping spans are masked once. Null and empty texts have
    no spans, repeated rows are masked alike, rows without a doc_id like any other. Columns of any name are allowed.
    An empty table stays empty.
    """
    found, spans = scan(docs, scope)
    upto = Window.partitionBy("uid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        spans.withColumn("before", F.coalesce(F.max("end").over(upto), F.lit(0)))
        .filter(F.col("end") > F.col("before"))
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "before"))).alias("runs"))
    )
    # Equal texts have equal spans.
    by_text = found.join(runs, "uid").groupBy("text_hash").agg(F.first("runs").alias("runs"))
    rows = row_keys(docs).select("row", "row_hash", F.xxhash64("text").alias("text_hash"))
    joined = lookup_join(rows, stage(by_text, "secret-runs"), ["text_hash"], "left", spread_by=["row_hash"], broadcast_bytes=broadcast_bytes)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    # A run that starts inside the one before goes on with the same mask.
    kept = F.transform("runs", lambda r: F.when(r["start"] >= r["before"], F.concat(F.substring(text, r["before"].cast("int") + 1, (r["start"] - r["before"]).cast("int")), F.lit(mask))).otherwise(""))
    rest = F.substring(text, F.element_at("runs", -1)["end"].cast("int") + 1, F.length(text))
    masked = F.when(F.col("runs").isNull(), F.col("row.text")).otherwise(F.concat(F.array_join(kept, ""), rest))
    changed = joined.select("row", "runs", masked.alias("masked"))
    out = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("masked")}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("runs").isNull(), F.col("row.n_chars")).otherwise(F.length("masked").cast("long"))
    return changed.select(*[column.alias(name) for name, column in out.items()])


def op5_secret_linking(spark: SparkSession, folder: str) -> DataFrame:
    return span_digests(read_table(spark, folder, "documents"))
