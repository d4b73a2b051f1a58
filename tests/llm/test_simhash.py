import random

import numpy as np
import pytest
import xxhash

from agroflow.llm import simhash

SCHEMA = "doc_id long, text string, fp string, n long"


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int64)[::977]
    low, high, patterns, count = simhash.golay_tables()
    assert set(np.unique(count)) == {1, 6}
    assert low[0] == high[0] == 0
    rows, index = simhash.codeword_indices(words)
    assert len(np.unique(rows)) == len(words) and index.max() < 4096


def test_words_within_two_bits_share_a_codeword():
    rng = random.Random(1)
    for _ in range(2000):
        a = rng.getrandbits(23)
        b = a ^ (1 << rng.randrange(23)) ^ (1 << rng.randrange(23))
        near = [set(simhash.codeword_indices(np.array([w]))[1].tolist()) for w in (a, b)]
        assert near[0] & near[1]


def by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    prints = [by_hand(t) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if bin(prints[i] ^ prints[j]).count("1") <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return sorted((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, label))


def test_matches_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}é" for i in range(60)] + ["The", "\x1cx", "a b"]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 80, 200]))]
        rows.append((i * 3, " ".join(base)))
        for k in range(rng.randrange(3)):
            copy = list(base)
            copy[-1] = rng.choice(words)
            rows.append((1000 + i * 5 + k, "\n".join(copy)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5002, " \t\n"), (5003, "THE w1é"), (5004, "the W1é")]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], SCHEMA)
    got = sorted(tuple(r) for r in simhash.near_duplicates(df).collect())
    assert got == components(rows)


@pytest.mark.parametrize("refine_above", [1, 2048])
def test_links_span_the_components_of_all_pairs(spark, refine_above):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(60):
            seed ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            prints.add(seed if rng.random() < 0.9 else rng.getrandbits(64))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 2, refine_above).collect()

    def classes(pairs):
        parent = {p: p for p in signed}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        out = {}
        for p in signed:
            out.setdefault(root(p), set()).add(p)
        return sorted(map(sorted, out.values()))

    every = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    assert classes([(r.a, r.b) for r in found]) == classes(every)


def test_empty_and_missing_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(None, "a b c d", None, None), (7, "a b c d", None, None), (None, "z z z", None, None)], SCHEMA)
    got = simhash.near_duplicates(df).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 7), (7, 7), (None, None)], key=str)


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "a b c d e f"), (3, "A b  c d e f"), (3, "A b  c d e f"), (9, None), (8, ""), (None, "x y z"), (None, "x y z"), (7, "other words here")]
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "doc_id long, text string, fp long")
    for limit in (0, 1 << 20):
        kept = simhash.keep_first_copies(df, broadcast_bytes=limit)
        assert kept.columns == df.columns
        assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 8, None, 7], key=str)
    assert simhash.keep_first_copies(df.limit(0)).count() == 0


def test_the_kept_rows_are_those_of_the_components(spark):
    """The stage keeps one row for each component of the operator, and the same one in every order of the rows."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(80):
        base = rng.choices(words, k=rng.choice([3, 40, 300]))
        for k in range(3):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.randrange(1000), " ".join(copy if rng.random() < 0.7 else base), k))
    schema = "doc_id long, text string, n int"
    wanted = {r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    first = sorted(map(tuple, simhash.keep_first_copies(spark.createDataFrame(rows, schema)).collect()))
    again = sorted(map(tuple, simhash.keep_first_copies(spark.createDataFrame(rows[::-1], schema).repartition(3)).collect()))
    assert first == again
    assert {r[0] for r in first} == wanted


def test_very_long_texts_with_more_hashes_than_a_block(spark):
    rng = random.Random(4)
    words = rng.choices([f"w{i}" for i in range(3000)], k=20_000)
    rows = [(1, " ".join(words)), (2, " ".join(words[:9000] + ["zz"] + words[9001:])), (3, "x " * 100_000)]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], SCHEMA)
    assert sorted(tuple(r) for r in simhash.near_duplicates(df).collect()) == components(rows)
