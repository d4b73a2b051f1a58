import hashlib
import random
from collections import Counter

import pytest

from agroflow.llm import repeats
from agroflow.llm.suffixes import common_prefixes, suffix_array


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(40))]
        array = suffix_array(s)
        assert array == sorted(range(len(s)), key=lambda i: s[i:])
        shared = common_prefixes(s, array, 5)
        for at in range(1, len(s)):
            a, b = s[array[at - 1] :], s[array[at] :]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[at] == min(same, 5)


def by_hand(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(raw[k : k + length] for _, raw in raws for k in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def sample(rng, n):
    words = [f"wörd{i}" for i in range(300)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.choice([8, 12, 20, 60]))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(rng.choice(passages)[rng.randrange(9) :])
            elif kind < 0.5:
                parts.append(rng.choice(["ab", "x", "For "]) * rng.randrange(90))
            else:
                parts.append(" ".join(rng.choice(words) for _ in range(rng.randrange(40))))
        rows.append((i, rng.choice(["", " ", "\n"]).join(parts)))
        if rng.random() < 0.3:
            base = list(rows[rng.randrange(len(rows))][1])
            for _ in range(rng.randrange(3)):
                if base:
                    base[rng.randrange(len(base))] = "é"
            rows.append((1000 + i, "".join(base)))
    return rows


@pytest.mark.parametrize("crowded", [2, 50_000])
def test_matches_brute_force(spark, crowded):
    rng = random.Random(3)
    rows = sample(rng, 70) + [(5000, None), (5001, ""), (5002, "a" * 79), (None, "tail " * 40), (7, "dup " + "z9 y8 " * 20), (7, "dup " + "z9 y8 " * 20)]
    df = spark.createDataFrame([(a, b, 1, "h") for a, b in rows], "doc_id long, text string, id int, runs string")
    got = repeats.remove_repeats(df.repartition(3), length=80, anchor=24, block=8, crowded=crowded).drop("kept")
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, 80)


def test_production_sizes(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passage = text(700)
    rows = [(i, text(rng.randrange(900)) + passage[rng.randrange(200) : 700 - rng.randrange(200)] + text(rng.randrange(900))) for i in range(40)]
    rows += [(100, text(399)), (101, text(400)), (102, rows[0][1]), (103, "q" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, repeats.remove_repeats(df).drop("kept").collect()), key=str) == by_hand(rows, 400)


def test_long_texts_are_cut_without_loss(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = repeats.anchors(data, 80, 24)
    monkeypatch.setattr(repeats, "SLICE", 700)
    repeats._powers.cache_clear()
    sliced = repeats.anchors(data, 80, 24)
    repeats._powers.cache_clear()
    assert (whole[0] == sliced[0]).all() and (whole[1] == sliced[1]).all()


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_crowded_anchor_is_divided(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passage = text(100)
    rows = [(i, text(rng.randrange(60, 90)) + passage + text(rng.randrange(60, 90))) for i in range(1600)]
    sizes, compared = [], repeats._compared

    def watched(contexts, *args):
        key = "group_hash" if "group_hash" in contexts.columns else "anchor_hash"
        sizes.extend(r["count"] for r in contexts.groupBy(key).count().collect())
        return compared(contexts, *args)

    monkeypatch.setattr(repeats, "_compared", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove_repeats(df, length=80, anchor=24, block=8).drop("kept")
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, 80)
    assert max(sizes) <= 1500
