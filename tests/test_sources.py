"""Text sources: malformed values, inferred types, text identifiers."""

import datetime

import pytest

from agroflow.operators import encoding, events, folds, metrics, rows
from agroflow.sources import tables
from pyspark.sql import functions as F


def write(path, text):
    path.write_text(text)
    return str(path)


def test_malformed_values_raise_with_their_counts(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,date,tavg,prec\n1,2015-05-01,1.5,2\n2,01/05/2015,1,x\nA7,2015-05-03,1,y\n")
    with pytest.raises(tables.MalformedValues, match=r"'date \(date\)': 1.*'id \(bigint\)': 1.*'prec \(double\)': 2"):
        tables.read_climate(spark, path)


def test_text_identifiers(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,date,tavg,prec\nA7,2015-05-01,,NaN\n007,2015-05-02,1,2\n")
    got = sorted(map(tuple, tables.read_climate(spark, path, id_type="string").collect()))
    assert got == [("007", datetime.date(2015, 5, 2), 1.0, 2.0), ("A7", datetime.date(2015, 5, 1), None, None)]


def test_undeclared_columns_get_the_type_of_all_their_values(spark, tmp_path):
    lines = ["n,f,d,t,b,s,late,none,id,gap"] + [f"{i},{i}.5,2020-01-0{i},2020-01-01 10:00:0{i},true,a{i},{i},,{i}.0,{i}.0" for i in range(1, 9)]
    path = write(tmp_path / "o.csv", "\n".join([*lines, "9,9,2020-02-01,2020-01-01 00:00:00,false,z,x,,9,"]))
    df = tables.read_csv(spark, path, {"id": "bigint"})
    assert dict(df.dtypes) == {"n": "bigint", "f": "double", "d": "date", "t": "timestamp", "b": "boolean", "s": "string",
                               "late": "string", "none": "string", "id": "bigint", "gap": "bigint"}
    assert df.agg(F.sum("id")).first()[0] == 45


def test_metrics_use_one_set_of_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 3.0), ("a", 100.0, None), ("a", float("nan"), 2.0)], "target string, y double, y_pred double")
    row = metrics.regression_metrics(df).first()
    assert (row["n"], row["n_missing"], row["rmse"], row["r2"]) == (2, 2, 0.0, 1.0)


def test_event_rows_do_not_follow_arrival(spark):
    schema = "id int, year int, climate_id int, " + ", ".join(f"{f}_date_{n} date" for n in (1, 2, 3) for f in ("manu", "fert"))
    day = lambda d: datetime.date(2001, 1, d)
    data = [(1, 2001, 5, day(d), None, None, None, None, None) for d in (6, 1, 4, 3, 2, 5)]
    for order in (data, data[::-1], sorted(data, key=str)):
        chosen = events.event_rows(spark.createDataFrame(order, schema).repartition(3)).collect()
        assert [r["manu_date_1"] for r in chosen] == [day(1)]


def test_first_row_of_equal_keys_is_fixed(spark):
    data = [(1, 0, x) for x in "cab"]
    for order in (data, data[::-1]):
        got = rows.first_per_key(spark.createDataFrame(order, "id int, year int, v string").repartition(2), ["id"], ["year"])
        assert got.first()["v"] == "a"


def test_equal_rows_spread_over_the_folds(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(2,)] * 3, "k int")
    folded = folds.shuffled_folds(df, ["k"], n_splits=5)
    assert folded.columns == ["k", "fold"]
    assert sorted(r["count"] for r in folded.groupBy("fold").count().collect()) == [2, 2, 3, 3, 3]
    assert folded.where("k = 1").select("fold").distinct().count() >= 3


def test_fewer_groups_than_folds_are_an_error(spark):
    with pytest.raises(ValueError, match="5 folds"):
        folds.group_folds(spark.createDataFrame([(1,), (2,)], "id int"), "id", 5)


def test_error_names_the_table_of_all_unseen_values(spark):
    known = encoding.category_dictionary(spark.createDataFrame([("a",)], "c string"), ["c"])
    many = spark.createDataFrame([(f"x{i}",) for i in range(50)], "c string")
    with pytest.raises(ValueError, match="all of them are in") as raised:
        encoding.apply_encoding(many, known)
    path = str(raised.value).rsplit(" ", 1)[1]
    assert spark.read.json(path).count() == 50 and "'c': 50" in str(raised.value)


def test_markers_stand_for_missing_values(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,date,tavg,prec\n1,2015-05-01,NA,2\n2,2015-05-02,1, n/a \n3,NULL,nan,-\n")
    with pytest.raises(tables.MalformedValues, match="prec"):
        tables.read_climate(spark, path)
    got = tables.read_csv(spark, path, {"id": "bigint", "prec": "double"}, missing=(*tables.MISSING_MARKERS, "-"))
    assert got.dtypes[:2] == [("id", "bigint"), ("date", "date")]
    assert sorted(map(tuple, got.select("id", "tavg", "prec").collect())) == [(1, None, 2.0), (2, 1.0, None), (3, None, None)]


def test_rejected_rows_go_to_a_table(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,prec,note\n1,2.5,a\nx,3,b\n3,y,c\n4,1\n5,1,e,f\n6,6,g\nq,z,h\n")
    types = {"id": "bigint", "prec": "double"}
    with pytest.raises(tables.MalformedValues, match="5 of 7 rows") as raised:
        tables.read_csv(spark, path, types)
    found = {r["text"]: (r["reason"], r["file"].endswith("c.csv")) for r in spark.read.parquet(raised.value.rejected).collect()}
    assert found == {"x,3,b": ("id (bigint)", True), "3,y,c": ("prec (double)", True), "4,1": ("number of fields", True),
                     "5,1,e,f": ("number of fields", True), "q,z,h": ("id (bigint), prec (double)", True)}
    target = str(tmp_path / "rejected")
    kept = tables.read_csv(spark, path, types, tolerate=0.8, rejected_path=target)
    assert sorted(map(tuple, kept.collect())) == [(1, 2.5, "a"), (6, 6.0, "g")]
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(tables.MalformedValues):
        tables.read_csv(spark, path, types, tolerate=0.5)


def test_undeclared_types_follow_the_rows_that_stay(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,n\n1,5\nx,word\n3,7\n")
    assert tables.read_csv(spark, path, {"id": "bigint"}, tolerate=0.5).dtypes == [("id", "bigint"), ("n", "bigint")]


def parts(spark, tmp_path, *frames):
    out = []
    for i, df in enumerate(frames):
        out.append(str(tmp_path / f"p{i}"))
        df.coalesce(1).write.parquet(out[-1])
    return out


def test_files_with_other_columns_and_types_are_united(spark, tmp_path):
    a = spark.createDataFrame([(1, 1.5)], "id int, v float")
    b = spark.createDataFrame([(2**40, 7, "x")], "id bigint, v int, extra string")
    c = spark.createDataFrame([("y", datetime.date(2020, 1, 2))], "extra string, day date")
    d = spark.createDataFrame([(datetime.datetime(2020, 1, 2, 3), 4)], "day timestamp, id smallint")
    paths = parts(spark, tmp_path, a, b, c, d)
    for order in (paths, paths[::-1], [paths[2], paths[0], paths[3], paths[1]]):
        df = tables.read_parquet(spark, *order)
        assert dict(df.dtypes) == {"id": "bigint", "v": "double", "extra": "string", "day": "timestamp"}
        rows_ = sorted(df.select("id", "v", "extra", F.col("day").cast("string")).collect(), key=str)
        assert [tuple(r) for r in rows_] == sorted([(1, 1.5, None, None), (2**40, 7.0, "x", None), (None, None, "y", "2020-01-02 00:00:00"), (4, None, None, "2020-01-02 03:00:00")], key=str)


def test_one_folder_of_files_that_differ(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([(1, 1)], "id int, v int").write.parquet(f"{folder}/year=2000")
    spark.createDataFrame([(2, 2.5, "x")], "id bigint, v double, extra string").write.parquet(f"{folder}/year=2001")
    spark.createDataFrame([(3, "y")], "id int, extra string").write.parquet(f"{folder}/year=2002")
    df = tables.read_parquet(spark, folder)
    assert sorted(map(tuple, df.select("id", "v", "extra", "year").collect())) == [(1, 1.0, None, 2000), (2, 2.5, "x", 2001), (3, None, "y", 2002)]


def test_conflicts_between_files_are_errors(spark, tmp_path):
    number, text, upper = (spark.createDataFrame([x], s) for x, s in (((1,), "id int"), (("a",), "id string"), ((2,), "ID bigint")))
    paths = parts(spark, tmp_path, number, text, upper)
    with pytest.raises(tables.SchemaConflict, match="id .*string"):
        tables.read_parquet(spark, paths[0], paths[1])
    both = tables.read_parquet(spark, paths[0], paths[2])
    assert both.dtypes == [("id", "bigint")] and sorted(r[0] for r in both.collect()) == [1, 2]


def test_filters_reach_the_files_of_every_part(spark, tmp_path, plan_of):
    paths = parts(spark, tmp_path, spark.createDataFrame([(1, 1)], "id int, v int"), spark.createDataFrame([(2, 5.0)], "id int, v double"))
    df = tables.read_parquet(spark, *paths, where=F.col("id") > 1)
    assert [tuple(r) for r in df.collect()] == [(2, 5.0)]
    assert plan_of(df).count("GreaterThan(id,1)") == 2


@pytest.mark.parametrize("a, b, wanted", [
    ("tinyint", "smallint", "smallint"), ("int", "float", "double"), ("smallint", "float", "float"), ("bigint", "double", "double"),
    ("date", "timestamp", "timestamp"), ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)"), ("decimal(5,2)", "int", None),
    ("string", "int", None), ("boolean", "int", None), ("void", "string", "string"), ("array<int>", "array<int>", "array<int>"),
    ("array<int>", "array<bigint>", None), ("timestamp", "timestamp_ntz", None), ("decimal(38,0)", "decimal(38,10)", None),
])
def test_types_widen_by_rule(spark, a, b, wanted):
    from pyspark.sql.types import DataType

    for x, y in ((a, b), (b, a)):
        kind = tables.common_type(DataType.fromDDL(x), DataType.fromDDL(y))
        assert (kind and kind.simpleString()) == wanted
