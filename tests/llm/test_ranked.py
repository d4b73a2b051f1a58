import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from agroflow.llm.ranked import Bucket, Query, ranked_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, all_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    queries = {}
    for item, text in set(items):
        queries.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, asked in queries.items():
        scored = []
        for doc_id, counts in counted:
            m = 25 + 75 * sum(counts.values()) * n_docs // all_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t, times in asked.items() if t in counts
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -s) for rank, (s, _, _, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    found = ranked_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 3, 8, 20, 120])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"bucket": 7, "head": 20}, {"bucket": 3, "head": 1, "block_bytes": 300}])
def test_equals_brute_force_with_any_buckets_head_and_blocks(spark, options):
    docs, items = corpus(400, 5)
    assert run(spark, docs, items, **options) == brute(docs, items)


def test_ties_repeats_nulls_and_a_missing_id(spark):
    docs = [(9, "a b"), (2, "a b"), (2, "a b"), (None, "a b"), (5, None), (6, ""), (7, "?!"), (8, "c")] + [(20 + i, "A  B") for i in range(9)]
    items = [(1, "a"), (1, "a"), (2, None), (3, "zzz"), (4, "c c a"), (None, "b"), (6, "?")]
    found = run(spark, docs, items)
    assert found == brute(docs, items)
    assert [r[2] for r in sorted(r for r in found if r[0] == 1)][:3] == [2, 2, 9]


def test_empty_tables_and_clashing_columns(spark):
    docs, items = [(1, "a b"), (2, "a c"), (3, "d")], [(1, "a b")]
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [(1, None)], items) == []
    wide = spark.createDataFrame([(*d, 1.5, "x", "y") for d in docs], DOCS + ", length double, terms string, id string")
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS + ", term string, doc_id long")
    assert sorted(tuple(r) for r in ranked_documents(wide, asked).collect()) == brute(docs, items)


def test_very_long_texts(spark):
    docs = [(1, "long " * 200_000 + "needle"), (2, "needle in hay"), (3, "hay " * 50)]
    items = [(1, "needle long"), (2, "hay")]
    assert run(spark, docs, items) == brute(docs, items)


def test_bounds_leave_out_most_documents_and_lose_none():
    rng = np.random.default_rng(3)
    size = np.full(2000, 30)
    found = np.concatenate([np.sort(rng.choice(3000, 30, replace=False)) for _ in size])
    impacts = rng.integers(1, 1000, len(found))
    length = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, np.r_[0, np.cumsum(size)[:-1]]))
    bucket = Bucket(np.arange(2000), length, size, found, impacts)
    query = Query.of(1, found[:30].tolist(), rng.integers(1, 9000, 30).tolist())
    scores = bucket.scores(query, np.arange(2000))
    threshold = int(np.sort(scores)[-10])
    kept = bucket.candidates(query, threshold)
    assert set(np.flatnonzero(scores >= threshold)) <= set(kept)
    assert len(kept) < 200
