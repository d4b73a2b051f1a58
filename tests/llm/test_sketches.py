import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from agroflow.llm import sketches


def by_hand(text, words=5, bits=3):
    tokens = [w for w in re.split("[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    if not tokens:
        return set()
    hashes = {xxhash.xxh64_intdigest(" ".join(tokens[i : i + words]), 42) for i in range(max(1, len(tokens) - words + 1))}
    return {h for h in hashes if h < 1 << 64 - bits} | {min(hashes)}


def as_text(hashes):
    return "".join(f"{h:016x}" for h in sorted(h - (h >> 63 << 64) for h in hashes)).replace("-", "") if not any(h >> 63 for h in hashes) else None


def near(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    return len(a & b) / min(len(a), len(b))


def test_matches_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)] + ["Ünder", "😀", "THE"]
    rows = [(i * 7 % 101, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 30, 300])))) for i in range(101)]
    rows += [(200, None), (201, rows[5][1]), (202, rows[5][1]), (203, rows[5][1]), (203, rows[5][1]), (203, rows[5][1]), (None, "a b c")]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, half int, start string")
    got = sketches.edited_fingerprints(df.repartition(5)).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    wanted = []
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a = by_hand(text)
        wanted.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near(a, by_hand(edited)), 9), round(near(a, by_hand(following)), 9)))
        for hashes, column in ((a, "fingerprint"), (by_hand(edited), "edited_fingerprint")):
            if as_text(hashes) is not None and i is not None and i < 200:
                assert next(r[column] for r in got if r.doc_id == i) == as_text(hashes)
    mine = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(mine, key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_containment_of_unequal_texts(spark, share):
    rng = random.Random(2)
    small = [f"s{rng.random()}" for _ in range(4000)]
    large = small[: int(4000 * share)] + [f"l{rng.random()}" for _ in range(60_000)]
    df = spark.createDataFrame([(" ".join(small), " ".join(large))], "a string, b string")
    got = df.select(sketches.containment(sketches.sketch(F.col("a")), sketches.sketch(F.col("b")))).first()[0]
    assert abs(got - share) < 0.1


def test_merge_is_the_sketch_of_both(spark):
    rng = random.Random(3)
    for n in (1, 3, 80):
        a, b = ([f"x{rng.randrange(99)}" for _ in range(n)] for _ in range(2))
        df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
        merged = df.select(sketches.merge(sketches.sketch(F.col("a"), 1), sketches.sketch(F.col("b"), 1))).first()[0]
        both = by_hand(" ".join(a), 1) | by_hand(" ".join(b), 1)
        assert {h % (1 << 64) for h in merged} == {h for h in both if h < 1 << 61} | {min(both)}


def test_empty_table_and_native_plan(spark, plan_of):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = sketches.edited_fingerprints(df)
    assert out.count() == 0 and "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
