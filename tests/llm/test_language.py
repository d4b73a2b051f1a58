import math
import random
from collections import Counter

import numpy as np

from agroflow.llm import language

SCHEMA = "doc_id long, page_id long, text string, declared string, suffix string, host string, domain string"
WORDS = {"aa": "the and of with that this".split(), "bb": "der und nicht das für ein".split()}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_fusion_matches_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lang = rng.choice(["aa", "bb"])
        text = rng.choice([sentence(rng, lang, 4), "", None, "42 !"])
        host = rng.choice(["h1.x.org", "h2.x.org", "z.com", None])
        domain = host and ".".join(host.split(".")[-2:])
        rows.append((None, i, text, rng.choice([lang, "aa", None]), host and host.split(".")[-1], host, domain))
    df = spark.createDataFrame(rows, SCHEMA)
    labelled = [(sentence(rng, lang, 20), lang) for lang in WORDS for _ in range(9)] + [(None, "aa"), ("zz", None), ("x", "")]
    languages, model = language.language_model(spark.createDataFrame(labelled, "text string, lang string"))
    assert languages == ["aa", "bb"]
    ll = [language._log_likelihoods(r[2] or "", model) for r in rows]
    said = [languages[int(np.argmax(x))] if min(x) < 0 else None for x in ll]
    totals = Counter(s for s in said if s)
    everywhere = {lang: (totals[lang] + 1) / (sum(totals.values()) + 2) for lang in languages}
    k = language.PRIOR_ROWS
    got = {r.page_id: r for r in language.identify(df, spark.createDataFrame(labelled, "text string, lang string")).collect()}
    for at, row in enumerate(rows):
        def other(column, lang):
            if row[column] is None:
                return 0
            return sum(o != at and rows[o][column] == row[column] and said[o] == lang for o in range(len(rows)))

        scores = {}
        for i, lang in enumerate(languages):
            share = lambda c, base, lang=lang: (other(c, lang) + k * base) / (sum(other(c, x) for x in languages) + k)
            score = ll[at][i] + math.log(share(5, share(6, everywhere[lang])))
            for column in (3, 4):
                if row[column] is not None:
                    score += math.log(share(column, everywhere[lang]) / everywhere[lang])
            scores[lang] = score
        best = max(scores, key=scores.get)
        confidence = 1 / sum(math.exp(s - scores[best]) for s in scores.values())
        assert got[at].lang == best and abs(got[at].confidence - confidence) < 1e-9 and got[at].text_lang == said[at]


def test_page_parts(spark):
    pages = [
        (1, "https://www.a.example.de/x", "<html class='n' LANG='DE-at'><head><script>var the</script></head><body>und &amp; das</body></html>"),
        (2, None, None), (3, "no address", "<p lang='fr'>text</p>"), (4, "http://localhost/", "<html>a</html>"),
    ]
    got = {r.page_id: r for r in language.page_rows(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].domain) == ("de", "de", "www.a.example.de", "example.de")
    assert got[1].text.split() == ["und", "das"]
    assert (got[2].declared, got[2].host, got[2].text) == (None, None, "") and got[3].declared is None
    assert (got[4].suffix, got[4].domain) == ("localhost", "localhost")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = [r for r in language.op1_language_fusion(spark, folder).collect() if r.held_out]
    assert len(got) > 30 and np.mean([truth[r.doc_id] == r.lang for r in got]) > 0.93


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "text string, lang string")
    rows = spark.createDataFrame([(1, None, "a", None, None, None, None)], SCHEMA)
    assert language.identify(rows, none).first().lang is None
    some = spark.createDataFrame([("a b", "aa"), ("c d", "bb")], none.schema)
    assert language.identify(rows.limit(0), some).count() == 0
    assert language.identify(rows.union(rows), some).count() == 2
