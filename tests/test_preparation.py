"""The whole workflow over a folder of files equals the lazy plan."""

import pytest
from pyspark.sql import functions as F

from agroflow import schemas
from agroflow.operators.encoding import read_dictionary
from agroflow.plans import preparation
from agroflow.plans.training_table import training_table
from agroflow.sources import tables
from checks.views import EDGE_YEARS, Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("data"))
    made = preparation.DataFolder(root, "wheat", {"climate": "rain/daily.csv"})
    t = Tables(spark, SMALL)
    tables.write_csv(t.climate, made.path("climate"))
    classes = t.classes.select(
        "id", *[F.lit(1.0).alias(c) for c in list(schemas.CLASS_TYPES)[1:-1]], F.col("aridity_index").alias("Aridity index")
    )
    tables.write_csv(classes, made.path("classes"))
    tables.write_parquet(t.sims, made.path("sims"))
    tables.write_parquet(t.soil, made.path("soil"))
    tables.write_csv(t.outputs, made.path("outputs_csv"))
    return made


def test_files_and_lazy_plan_agree(spark, folder, same):
    t = Tables(spark, SMALL)
    from_files = preparation.run_preparation(spark, folder, "winter", parquet=False, incomplete_years=EDGE_YEARS)
    lazy = preparation.prepare(t.outputs, t.climate, t.classes, t.sims, t.soil, "winter", EDGE_YEARS)
    same(from_files, lazy)
    assert spark.read.parquet(folder.path("sims_climate")).where("harvest_year is null").count() > 0

    table = preparation.run_training_table(spark, folder)
    same(table, training_table(lazy, t.climate).table)
    assert table.columns[:4] == list(schemas.TARGETS)
    assert table.columns[4:16] == [*schemas.LABEL_COLUMNS, *schemas.ORDINAL_COLUMNS]
    assert not set(schemas.UNUSED_AFTER_PREPARATION) & set(table.columns)
    dictionary = read_dictionary(spark, folder.path("dictionary"))
    assert dictionary.select("column").distinct().count() == 12


def test_unknown_crop_type(spark, folder):
    with pytest.raises(ValueError):
        preparation.run_preparation(spark, folder, "autumn")


def test_events_year_by_year(spark):
    t = Tables(spark, SMALL)
    lazy = preparation.prepare(t.outputs, t.climate, t.classes, t.sims, t.soil, "winter", EDGE_YEARS)
    table = training_table(lazy, t.climate, ("id", "year")).table
    assert table.count() == lazy.count()


def test_spring_crop(spark):
    t = Tables(spark, SMALL)
    lazy = preparation.prepare(t.outputs, t.climate, t.classes, t.sims, t.soil, "spring", EDGE_YEARS)
    assert "total_precipitation_summer" in lazy.columns and lazy.count() > 0


def test_csv_reader_takes_columns_by_name(spark, tmp_path):
    path = tmp_path / "rain.csv"
    path.write_text("prec,id,date,note\n1.5,7,2015-05-01,x\nNaN,8,2015-05-02,\n,9,2015-05-03,z\n")
    df = tables.read_climate(spark, str(path))
    assert df.dtypes == [("prec", "double"), ("id", "bigint"), ("date", "date"), ("note", "string")]
    assert [r["prec"] for r in df.orderBy("id").collect()] == [1.5, None, None]


def test_partitioned_and_split_writes(spark, tmp_path):
    df = spark.range(100).withColumn("year", (F.col("id") % 4).cast("int"))
    path = str(tmp_path / "out")
    tables.write_parquet(df.coalesce(1), path, partition_by=("year",), max_records_per_file=10)
    assert len(list((tmp_path / "out").glob("year=*/*.parquet"))) == 12
    assert tables.read_parquet(spark, path).count() == 100
