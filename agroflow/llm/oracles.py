"""SQL of the queries that SQL can express, for an engine in which the tables are registered as views.

Plain SQL gives the whole results of secret linking, ranked search and the filter audit: the others need tokens,
fitted models, a hash function that the engine lacks, or more memory than whole tables leave.
"""

from __future__ import annotations

from agroflow.llm import secrets


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _spelled(pattern: str) -> str:
    """A pattern with its (?i:...) groups spelled out: the engine's own mode also folds letters above ASCII."""
    out, rest = "", pattern
    while "(?i:" in rest:
        before, _, rest = rest.partition("(?i:")
        inner, _, rest = rest.partition(")")
        out += before + "(?:" + _either_case(inner) + ")"
    return out + rest


_PATTERNS = {kind: _quoted(_spelled(pattern)) for kind, pattern in secrets.PATTERNS.items()}
_FOUND = "\n  UNION ALL ".join(
    f"SELECT uid, '{kind}' AS kind, regexp_extract_all(text, {p}) AS v, string_split_regex(text, {p}) AS g FROM texts"
    for kind, p in _PATTERNS.items()
)
_ORDER = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"

SECRETS = f"""
WITH texts AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents
), found AS (
  {_FOUND}
), spots AS (
  SELECT uid, kind, unnest(v) AS value, unnest(g[1:len(v)]) AS gap, generate_subscripts(v, 1) AS nth FROM found WHERE len(v) > 0
), placed AS (
  SELECT uid, kind, value, length(value) AS n,
         sum(length(gap) + length(value)) OVER (PARTITION BY uid, kind ORDER BY nth) AS e FROM spots
), parts AS (
  SELECT uid, CASE WHEN kind = 'assign' AND length(regexp_extract(value, {_PATTERNS["assign"]}, 2)) < 6 THEN 'weak' ELSE kind END AS kind,
         e - n AS s, e
  FROM placed
  WHERE kind <> 'weak' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]'))
), base AS (
  SELECT * FROM parts WHERE kind IN ('assign', 'access', 'hex')
), weak AS (
  SELECT * FROM parts p WHERE kind IN ('ident', 'weak', 'endpoint')
     AND NOT EXISTS (SELECT 1 FROM base b WHERE b.uid = p.uid AND b.s < p.e AND b.e > p.s)
), others AS (
  SELECT uid, s, e, kind IN ('access', 'ident') AS names FROM (SELECT * FROM base UNION ALL SELECT * FROM weak WHERE kind <> 'endpoint')
), met AS (
  SELECT w.uid, w.kind, w.s, w.e, bool_or(names) AS name, bool_or(NOT names) AS secret
  FROM weak w JOIN others o ON o.uid = w.uid AND o.s - w.e <= {secrets.SCOPE} AND w.s - o.e <= {secrets.SCOPE}
  GROUP BY ALL
), spans AS (
  SELECT uid, kind, s, e FROM base
  UNION ALL SELECT uid, kind, s, e FROM met
  WHERE kind = 'ident' AND secret OR kind = 'weak' AND name OR name AND secret
), listed AS (
  SELECT uid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, list_position({_ORDER}, kind), e)
           FILTER (kind IN ('assign', 'access', 'hex')) AS base_spans,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, list_position({_ORDER}, kind), e) AS spans
  FROM spans GROUP BY uid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (uid)
"""

FILTER_AUDIT = r"""
WITH rows AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, [w FOR w IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF w <> ''] AS words,
         doc_id > min(doc_id) OVER (PARTITION BY text) AS later
  FROM rows
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), judged AS (
  SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN later THEN 'E' ELSE '' END AS fails
  FROM worded w LEFT JOIN marks m ON m.doc_id = w.doc_id
), sets AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL
), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, left(filter_order, step - 1) AS earlier
  FROM orders, range(1, 6) t(step)
), seen AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f, n, good, toxic, fails = f AS only_this,
         contains(fails, f) AS fails_this,
         length(translate(fails, earlier, '')) < length(fails) AS removed_before
  FROM steps, sets
), counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT fails_this AND NOT removed_before THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails_this AND NOT removed_before THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails_this AND removed_before THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails_this AND NOT removed_before THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails_this AND NOT removed_before THEN toxic ELSE 0 END) AS toxic_lost
  FROM seen GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

RANKED_SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, doc_id, text FROM documents WHERE text IS NOT NULL
), terms AS (
  SELECT uid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counts AS (
  SELECT uid, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), lengths AS (
  SELECT uid, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY uid
), totals AS (
  SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM lengths
), asked AS (
  SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL
), query_terms AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM asked)
  GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals WHERE term IN (SELECT term FROM query_terms) GROUP BY term, N
), impacts AS (
  SELECT c.uid, c.doc_id, c.term, (1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 75 + (75 * l.n * t.N) // t.L)) AS impact
  FROM counts c JOIN lengths l USING (uid), totals t WHERE c.term IN (SELECT term FROM weights)
), scored AS (
  SELECT q.item_id, i.doc_id, CAST(sum(q.times * w.w * i.impact) AS BIGINT) AS score
  FROM query_terms q JOIN weights w USING (term) JOIN impacts i USING (term) GROUP BY q.item_id, i.uid, i.doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
