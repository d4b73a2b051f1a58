import itertools
import random
import zlib

import numpy as np
import pytest

from agroflow.llm import toxicity

WORDS = "the river runs over green stones while people talk about idiot moron stupid weather and gardens".split()


@pytest.fixture(scope="module")
def decoder(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(60))) for i in range(60)]
    return toxicity.Decoder(toxicity.trigram_counts(spark.createDataFrame(rows, "doc_id long, text string")))


def test_trigram_counts(spark):
    counts = toxicity.trigram_counts(spark.createDataFrame([(1, "Ab é"), (2, None), (3, "ab")], "doc_id long, text string"))
    code = toxicity._CODE_OF
    cube = counts.reshape((toxicity.SIZE,) * 3)
    assert cube[0, code["a"], code["b"]] == 2 and cube[code["a"], code["b"], 0] == 2 and cube[0, code["é"], 0] == 1


@pytest.mark.parametrize("span", ["1d10t", "m0r0n", "$tup1d", "s.t.u.p.i.d", "idiooot", "we4ther", "gggreen", "x9", "a b c d", "a$$", "idi0+", "u a n d i"])
def test_viterbi_is_the_best_path(decoder, span):
    def score(path):
        codes = [0, 0] + [toxicity._CODE_OF.get(t, 0) for t, _ in path if t] + [0]
        return sum(p for _, p in path) + sum(float(decoder._log[a, b, c]) for a, b, c in zip(codes, codes[1:], codes[2:]))

    paths = list(itertools.product(*(decoder.options(span, at) for at in range(len(span)))))
    best = max(paths, key=score)
    text = decoder.decode(span)
    same = [p for p in paths if "".join(t for t, _ in p) == text]
    assert max(map(score, same)) == pytest.approx(score(best), abs=1e-4)


def test_disguised_words_are_restored(decoder):
    assert decoder.restore("You 1d10t and M0R0N, $tupid!!") == "you idiot and moron, stupid!!"
    assert decoder.restore("s t u p i d weather") == "stupid weather"
    assert decoder.restore("i.d.i.o.t") == "idiot" and decoder.restore("stuuuuupid") == "stupid"
    assert decoder.restore("plain text*** stays, 42 too###") == "plain text*** stays, 42 too###"


def test_spacing_beside_other_words_is_decoded(decoder):
    assert decoder.restore("such a s t u p i d person") == "such a stupid person" or decoder.restore("over s t u p i d moron") == "over stupid moron"
    assert decoder.restore("the s  t u  p i d weather") == "the stupid weather"
    assert decoder.restore("m\no\nr\no\nn") == "moron"
    assert decoder.restore("t h e i d i o t") == "the idiot"


def test_final_signs_are_decoded_where_the_model_prefers_a_letter(decoder):
    assert decoder.restore("that idio+") == "that idiot"
    assert decoder.restore("green stone$!") == "green stones!"
    assert decoder.restore("weather! rivers, 5$ and 3+4") == "weather! rivers, 5$ and 3+4"


def test_quick_test_misses_no_disguise(decoder):
    rng = random.Random(7)
    bits = ["a", "b", "é", "1", "$", "!", " ", " ", ".", "-", "_", "²", "ß", "aa", "the", "\n", "0", "œ", "#"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        if not toxicity.may_be_disguised(text):
            assert not toxicity._APART.search(text) and not toxicity._MIXED.search(text) and not toxicity._REPEATED.search(text)
        words = {w.encode("latin-1", "ignore") for w in toxicity._WORD.findall(text) if "œ" not in w}
        assert words <= toxicity.words_of(text)


def test_curve_is_the_best_rising_one():
    rng = random.Random(3)
    for _ in range(50):
        n = np.array([rng.randrange(4) for _ in range(8)], float)
        toxic = np.array([rng.randrange(int(k) + 1) for k in n], float)
        if not n.any():
            continue
        places, shares = toxicity.isotonic(toxic, n)
        assert places == sorted(places) and shares == sorted(shares)
        used = np.flatnonzero(n)
        fitted = np.interp((used + 0.5) / 8, places, shares)
        # Least squares over all rising curves, by min-max of means.
        mean = lambda i, j: toxic[used[i : j + 1]].sum() / n[used[i : j + 1]].sum()
        k = len(used)
        wanted = [max(min(mean(i, j) for j in range(at, k)) for i in range(at + 1)) for at in range(k)]
        assert np.allclose(fitted, wanted)


def test_own_label_is_left_out():
    counts = {b"idiot$": (3, 3)}
    heads = {b"idio"}
    assert toxicity.words_evidence({b"idiot"}, counts, heads, 0.1) > toxicity.words_evidence({b"idiot"}, counts, heads, 0.1, own=1) > 0
    assert toxicity.words_evidence({b"other"}, counts, heads, 0.1) == 0


def corpus(n=600):
    rng = random.Random(2)
    clean = [w for w in WORDS if w not in ("idiot", "moron", "stupid")]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 80))]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "moron", "stupid"] if i % 2 else ["1d10t", "m0r0n", "stup1d", "i d i o t"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(9000, None, "x"), (9001, "", "x"), (None, "idiot", "x"), (3, rows[3][1], "x")], "doc_id long, text string, toxic string")
    truth = spark.createDataFrame(labels + [(0, None), (None, 1), (5, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, truth).collect()
    assert len(got) == len(rows) + 4
    known = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    test = [r for r in got if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == known[r.doc_id] for r in test]) > 0.97
    assert len(blank := {r.score for r in got if r.doc_id in (9000, 9001)}) == 1 and max(blank) < 0.3
    kept = toxicity.reject_toxic(docs, truth)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_rejecting_hands_rows_on_in_small_steps(spark, monkeypatch):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = sorted(map(tuple, toxicity.reject_toxic(docs, truth).collect()))
    monkeypatch.setattr(toxicity, "STEP_ROWS", 7)
    kept = toxicity.reject_toxic(docs, truth)
    assert sorted(map(tuple, kept.collect())) == whole
    assert 0 < len(whole) < len(rows)


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    a, b = (sorted(map(tuple, toxicity.score_toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect())) for x in (labels, flipped))
    assert a == b


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, labels).count() == 0
    assert toxicity.score_toxicity(spark.createDataFrame([(1, "a")], docs.schema), labels).first().score == 0.0


def test_long_words_take_linear_time(decoder):
    assert decoder.restore("ab" * 200_000) == "ab" * 200_000
    assert decoder.restore("a" * 3000).count("a") < 3000
