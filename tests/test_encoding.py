"""Category dictionaries."""

import pytest

from agroflow.operators import encoding


@pytest.fixture
def known(spark):
    return spark.createDataFrame([(10, "b", 1.5), (2, "a", None), (None, "b", 10.0), (2, None, 9.0)], "n int, s string, f float")


def test_codes_follow_the_type(known):
    coded, dictionary = encoding.fit_encode(known, ["n", "s", "f"])
    assert sorted(map(tuple, coded.collect())) == sorted([(1, 1, 0), (0, 0, -1), (-1, 1, 2), (0, -1, 1)])
    assert coded.dtypes == [("n", "int"), ("s", "int"), ("f", "int")]
    entries = {(r["column"], r["code"]): r["value"] for r in dictionary.collect()}
    assert entries[("n", 0)] == "2" and entries[("n", 1)] == "10"
    assert [entries[("f", i)] for i in range(3)] == ["1.5", "9.0", "10.0"]


def test_decoding_gives_the_values_back(known):
    coded, dictionary = encoding.fit_encode(known, ["n", "s", "f"])
    values = {(r["column"], r["code"]): r["value"] for r in dictionary.collect()}
    back = [tuple(values.get((c, r[c])) for c in ("n", "s", "f")) for r in coded.collect()]
    wanted = [tuple(None if v is None else str(v) for v in r) for r in known.collect()]
    assert sorted(back, key=str) == sorted(wanted, key=str)


def test_strict_apply(spark, known, tmp_path):
    path = str(tmp_path / "dictionary")
    encoding.write_dictionary(encoding.category_dictionary(known, ["n", "s"]), path)
    dictionary = encoding.read_dictionary(spark, path)
    fine = spark.createDataFrame([(2, "b"), (None, None)], "n bigint, s string")
    assert [tuple(r) for r in encoding.apply_encoding(fine, dictionary).collect()] == [(0, 1), (-1, -1)]
    with pytest.raises(ValueError, match="s"):
        encoding.apply_encoding(fine.drop("s"), dictionary)
    unseen = spark.createDataFrame([(2, "zebra"), (77, "a")], "n int, s string")
    with pytest.raises(ValueError) as error:
        encoding.apply_encoding(unseen, dictionary)
    assert "zebra" in str(error.value) and "77" in str(error.value)


def test_values_of_another_type_are_unknown(spark, known):
    dictionary = encoding.category_dictionary(known, ["n"])
    texts = spark.createDataFrame([("2",), ("two",)], "n string")
    got = [tuple(r) for r in encoding.unknown_categories(texts, dictionary).collect()]
    assert got == [("n", "two")]


def test_missing_column_on_fit(known):
    with pytest.raises(ValueError, match="zz"):
        encoding.category_dictionary(known, ["zz"])
