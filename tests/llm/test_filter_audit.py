import random
import re
from itertools import permutations

from agroflow.llm.filter_audit import audit_filters, coalition_values, potentials

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"
NAMES = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(doc_id, text, docs):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = ""
    out += "A" if len(words) < 100 else ""
    out += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    smaller = any(t == text and d is not None and doc_id is not None and d < doc_id for d, t in docs)
    return out + ("E" if smaller else "")


def brute(docs, labels):
    plain = [(d, t or "", p or "") for d, t, p in docs]
    pairs = [(d, t) for d, t, _ in plain]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    rows = [(d, p, fails(d, t, pairs)) for d, t, p in plain]
    out = []
    for part in {p for _, _, p in plain}:
        mine = [(d, f) for d, p, f in rows if p == part]
        shares = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in left if name in f]
                left = [(d, f) for d, f in left if name not in f]
                failing = sum(name in f for _, f in mine)
                shares[name] += len(gone)
                found.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(f == name for _, f in mine),
                              sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), name])
        out += [(*r[:-1], shares[r[-1]]) for r in found]
    return sorted(out)


def run(spark, docs, labels, **options):
    found = audit_filters(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), **options)
    assert found.columns == list(NAMES)
    return sorted(tuple(r) for r in found.collect())


def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.choice([5, 99, 100, 150]))) for _ in range(40)]
    texts += [" ".join(words[:120]), " ".join(words[:120]).upper(), "\t" + " ".join(words[:110]) + " $\n", "ÉÉ AB", ""]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)]
    return docs, labels


def test_equals_brute_force(spark):
    docs, labels = corpus()
    assert run(spark, docs, labels) == brute(docs, labels)


def test_without_broadcasts(spark):
    docs, labels = corpus()
    assert run(spark, docs, labels, broadcast_bytes=0) == brute(docs, labels)


def test_nulls_repeated_rows_and_repeated_labels(spark):
    docs = [(1, None, None), (2, "", ""), (2, "", ""), (None, "x $", "fr"), (None, "x $", "fr"), (3, "x $", "fr"), (4, "x $", "fr")]
    labels = [(4, 0, 1), (4, 1, None), (None, 1, 1), (3, None, None), (2, 1, 0)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_edges_of_the_conditions(spark):
    docs = [(1, " ".join(f"w{i}" for i in range(100)), "a"), (2, " ".join(f"w{i % 80}" for i in range(100)), "a"),
            (3, " ".join(f"w{i % 79}" for i in range(100)), "a"), (4, "A" + "b" * 9, "a"), (5, "AB" + "b" * 17, "a"), (6, "\x1f\x85", "a")]
    assert run(spark, docs, []) == brute(docs, [])


def test_very_long_text(spark):
    docs = [(1, "word " * 300_000, "a"), (2, " ".join(map(str, range(200_000))), "a"), (3, "word " * 300_000, "b")]
    assert run(spark, docs, []) == brute(docs, [])


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    docs, labels = corpus()
    wide = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], DOCS + ", failed int, digest string, toxic int")
    more = spark.createDataFrame([(*x, "y") for x in labels], LABELS + ", part string")
    assert sorted(tuple(r) for r in audit_filters(wide, more).collect()) == brute(docs, labels)


def test_potential_differences_share_out_what_is_removed(spark):
    sets = spark.createDataFrame([("a", m, (m * 7) % 11, 0, 0) for m in range(32)], "part string, failed int, n long, good long, toxic long")
    row = potentials(coalition_values(sets)).first()
    shares = [row["potential"][31] - row["potential"][31 ^ 1 << i] for i in range(5)]
    assert sum(shares) == 120 * row["v_n"][31]
    assert row["potential"][1] == 120 * row["v_n"][1]
