"""Stored buckets are joined without an exchange; the run log survives writers that meet or are stopped."""

import threading

import pytest
from pyspark.sql import functions as F

from agroflow.sources import run_log
from agroflow.sources.storage import bucket_spec, join_stored, write_bucketed


@pytest.fixture
def stored(spark):
    left = spark.range(1000).select((F.col("id") % 300).alias("id"), (F.col("id") * 3).alias("a"))
    right = spark.range(200).select("id", (F.col("id") + 0.5).alias("b"))
    yield write_bucketed(left, "panel_buckets", ["id"], 4), write_bucketed(right, "lookup_buckets", ["id"], 4)
    for name in ("panel_buckets", "lookup_buckets"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_like_buckets_are_joined_where_they_lie(spark, stored, plan_of):
    panel, _ = stored
    joined = join_stored(panel, "lookup_buckets", ["id"])
    text = plan_of(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == sum(1 for i in range(1000) if i % 300 < 200)
    assert bucket_spec(spark, "panel_buckets") == (4, ["id"])


def test_only_the_side_that_is_not_stored_moves(spark, stored, plan_of):
    new = spark.range(50).select("id", F.lit("x").alias("c"))
    text = plan_of(join_stored(new, "panel_buckets", ["id"], "left"))
    assert text.count("Exchange") == 1
    with pytest.raises(ValueError, match="stored by"):
        join_stored(new, "panel_buckets", ["c"])


def test_aggregates_by_the_key_need_no_exchange(stored, plan_of):
    panel, _ = stored
    assert "Exchange" not in plan_of(panel.groupBy("id").agg(F.sum("a")))


def records(spark, names, token=None):
    rows = [(n, t, 1.0, 1.0, 0.5) for n in names for t in ("soc", "no3")]
    metrics = spark.createDataFrame(rows, "run_name string, target string, rmse double, mae double, r2 double")
    return run_log.run_records(metrics, "f", ["a"], "x", token=token)


def test_writers_at_the_same_time_keep_all_records(spark, tmp_path):
    log = str(tmp_path)
    threads = [threading.Thread(target=lambda i=i: run_log.append_runs(records(spark, [f"r{i}", f"s{i}"]), "e", log)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert {r.run_name for r in run_log.read_runs(spark, log, "e").collect()} == {f"{x}{i}" for x in "rs" for i in range(4)}


def test_a_writer_that_was_stopped_leaves_a_readable_log(spark, tmp_path):
    log = str(tmp_path)
    run_log.append_runs(records(spark, ["a"]), "e", log)
    run_log.append_runs(records(spark, ["b", "c"]), "e", log)
    part = next(p for p in tmp_path.glob("experiments/*/part-*.json") if p.read_text().count("\n") == 2)
    lines = part.read_text().splitlines()
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    part.write_text(lines[0] + "\n" + lines[1][:40])
    (tmp_path / "experiments/cut/_temporary/0").mkdir(parents=True)
    (tmp_path / "experiments/cut/_temporary/0/part-0.json").write_text(lines[0][:10])
    assert [r.run_name for r in run_log.read_runs(spark, log, "e").collect()] == ["a"]
    assert run_log.compact_runs(spark, log) == 1
    assert part.exists()


def test_compaction_keeps_what_is_read(spark, tmp_path, same):
    log = str(tmp_path)
    for i in range(3):
        run_log.append_runs(records(spark, ["a", f"n{i}"]), f"e{i % 2}", log)
    rows = sorted(map(tuple, run_log.read_runs(spark, log).select("run_id", "timestamp", "run_name", "experiment_name").collect()))
    latest = sorted(map(tuple, run_log.read_runs(spark, log, latest=True).select("run_id", "run_name").collect()))
    assert run_log.compact_runs(spark, log) == 3
    assert len(list(tmp_path.glob("experiments/*/part-*.json"))) == 1
    assert sorted(map(tuple, run_log.read_runs(spark, log).select("run_id", "timestamp", "run_name", "experiment_name").collect())) == rows
    assert sorted(map(tuple, run_log.read_runs(spark, log, latest=True).select("run_id", "run_name").collect())) == latest
    assert run_log.compact_runs(spark, log) == 1


def test_a_compaction_that_was_stopped_counts_nothing_twice(spark, tmp_path):
    log = str(tmp_path)
    for i in range(2):
        run_log.append_runs(records(spark, [f"n{i}"]), "e", log)
    known = run_log._complete_records(spark, log).drop("batch", "batch_size", "file")
    run_log._write_batch(known, log, run_log.new_token())
    assert run_log.read_runs(spark, log).count() == 2
