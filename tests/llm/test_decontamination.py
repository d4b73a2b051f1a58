import random

import numpy as np

from agroflow.llm import decontamination as dc


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = dc.MATCH if a[i - 1] == b[j - 1] else dc.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + s, table[i - 1][j] - dc.GAP, table[i][j - 1] - dc.GAP)
    return max(map(max, table))


def test_alignment_matches_the_textbook():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (np.array([rng.randrange(6) for _ in range(rng.randrange(1, 25))]) for _ in range(2))
        assert dc.align(a, b)[0] == smith_waterman(list(a), list(b))


def edited(words, rng, share, vocabulary):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(rng.choice(vocabulary) if x < 2 * share / 3 else w)
        if x > 1 - share / 3:
            out.append(rng.choice(vocabulary))
    return out


def tables(spark, rng):
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 12, 40])))) for i in range(30)]
    docs = []
    for d in range(200):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 10, 300]))]
        if d % 3 == 0:
            part = rng.choice(items)[1].split()
            at = rng.randrange(len(words) + 1)
            words[at:at] = edited(part, rng, rng.choice([0, 0.15]), vocabulary)
        docs.append((d, " ".join(words).title().replace(" ", ", " if d % 2 else " ")))
    return docs, items


def has_run(text, passage):
    words, item = dc.words_of(text or ""), dc.words_of(passage or "")
    size = min(len(item), dc.SEED_WORDS + dc.SEED_WINDOW - 1)
    runs = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
    return any(tuple(item[k : k + size]) in runs for k in range(len(item) - size + 1))


def test_matches_brute_force_alignment(spark):
    docs, items = tables(spark, random.Random(2))
    docs += [(900, None), (901, ""), (3, docs[3][1]), (None, docs[0][1])]
    items += [(100, None), (101, "..."), (0, items[0][1])]
    d = spark.createDataFrame([(a, b, 1.0) for a, b in docs], "doc_id long, text string, score double")
    b = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, doc_id int")
    got = dc.contaminated(d, b).collect()
    numbers = {}
    number = lambda text: np.array([numbers.setdefault(w, len(numbers)) for w in dc.words_of(text or "")])
    wanted = []
    for doc_id, text in docs:
        for item_id, passage in dict(items).items():
            words, item = number(text), number(passage)
            if len(words) and len(item):
                score = dc.align(words, item)[0] / (dc.MATCH * len(item))
                if score >= dc.MIN_SCORE:
                    wanted.append((doc_id, item_id, round(score, 9)))
    mine = [(r.doc_id, r.item_id, round(r.score, 9)) for r in got]
    # Whatever scores enough and holds words of the item in a row, enough to have a seed, is found, and nothing else.
    sure = [(d, i, s) for d, i, s in wanted if has_run(dict(docs).get(d) if d is not None else docs[0][1], dict(items)[i])]
    assert set(sure) <= set(mine) <= set(wanted) and len(sure) > 60
    assert len(set(wanted) - set(mine)) <= 0.03 * len(wanted)
    assert mine.count(mine[0]) == [w for w in wanted].count(mine[0])
    assert sorted(map(str, (m for m in mine if m in set(sure)))) == sorted(map(str, sure))
    kept = dc.drop_contaminated(d, b)
    bad = {r.doc_id for r in got}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in docs if i not in bad), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(docs, none).count() == 0
    assert dc.contaminated(docs.limit(0), spark.createDataFrame([(1, "a b c")], none.schema)).count() == 0
    assert dc.drop_contaminated(docs, none).count() == 1


def test_a_small_filter_loses_nothing(spark, monkeypatch):
    docs, items = tables(spark, random.Random(4))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.contaminated(d, b).collect()))
    monkeypatch.setattr(dc, "FILTER_BITS", 8)
    assert sorted(map(tuple, dc.contaminated(d.repartition(7), b).collect())) == whole and len(whole) > 50


def test_joined_by_shuffle_it_finds_the_same(spark, monkeypatch):
    docs, items = tables(spark, random.Random(5))
    docs += [(1000 + i, "before " + items[3][1] + " after") for i in range(50)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.contaminated(d, b).collect()))
    join = dc.lookup_join
    monkeypatch.setattr(dc, "lookup_join", lambda *a, **k: join(*a, **{**k, "broadcast_bytes": 0}))
    assert sorted(map(tuple, dc.contaminated(d, b).collect())) == whole


def test_very_long_texts(spark):
    rng = random.Random(6)
    item = " ".join(f"w{rng.randrange(300)}" for _ in range(40))
    text = " ".join(f"w{rng.randrange(300)}" for _ in range(150_000))
    docs = spark.createDataFrame([(1, text + " " + item + " " + text), (2, text)], "doc_id long, text string")
    found = dc.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score, r.end_word) for r in found] == [(1, 7, 1.0, 150_040)]


def test_no_task_keeps_two_python_workers(spark, plan_of):
    docs, benchmark = (spark.createDataFrame([(1, "one two three four five six seven eight")], f"{c} long, text string") for c in ("doc_id", "item_id"))
    found = dc.contaminated(docs, benchmark)
    # Stretches are cut in a stage of their own; the last one only aligns.
    assert plan_of(found).count("MapInArrow") == 1
    assert [tuple(r) for r in found.select("doc_id", "item_id", "score").collect()] == [(1, 1, 1.0)]
