"""Stages leave columns of any name as they are."""

import pytest

from agroflow.llm.decontamination import drop_contaminated
from agroflow.llm.secrets import redact
from agroflow.llm.simhash import keep_first_copies
from agroflow.llm.toxicity import reject_toxic

NAMES = ["_id", "_hash", "_missing", "_n", "_runs", "_text_hash", "row", "row_hash", "text_hash", "fp", "n", "id", "uid", "missing",
         "masked", "runs", "_salt", "key", "score", "start", "end", "kind"]
SCHEMA = "doc_id long, text string, n_chars long, tags map<string,int>, " + ", ".join(f"`{c}` string" for c in NAMES)
ITEM = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [(1, "some words of a first document here"), (2, "a second text that differs in every word"), (3, None), (4, ""),
        (None, "no id but words of its own kind"), (6, 'token = "0123456789abcdef0123456789abcdef" and more'), (7, f"before {ITEM} after")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None if t is None else len(t), {"a": 1}, *[f"{i}-{c}" for c in NAMES]) for i, t in rows], SCHEMA)


def others(df):
    return sorted((str(r.doc_id), *[r[c] for c in NAMES], tuple(r.tags)) for r in df.collect())


@pytest.mark.parametrize("rows", [ROWS, []])
def test_columns_of_any_name_stay(spark, rows):
    docs = table(spark, rows)
    items = spark.createDataFrame([(1, ITEM, "x")], "item_id long, text string, text_hash string")
    labels = spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], "doc_id long, toxic int, score string")
    for out, gone in ((redact(docs), set()), (drop_contaminated(docs, items), {7}), (keep_first_copies(docs), {4}), (reject_toxic(docs, labels), set())):
        assert out.columns == docs.columns
        assert out.dtypes == docs.dtypes
        assert others(out) == others(table(spark, [r for r in rows if r[0] not in gone]))


def test_masks_and_counts(spark):
    found = {r.doc_id: r for r in redact(table(spark, [*ROWS, *ROWS])).collect()}
    assert found[6].text.startswith("[REDACTED]") and found[6].n_chars == len(found[6].text)
    assert found[3].text is None and found[3].n_chars is None and found[1].text == ROWS[0][1]


def test_without_broadcasts(spark):
    docs = table(spark, ROWS)
    assert others(redact(docs, broadcast_bytes=0)) == others(docs)
    assert len(others(keep_first_copies(docs, broadcast_bytes=0))) == len(ROWS) - 1
