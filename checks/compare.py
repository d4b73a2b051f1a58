"""Run registered queries against their SQL in an in-process DuckDB and report differences.

    python -m checks.compare [scale folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from agroflow.session import with_settings
from checks.oracle import ORACLE
from checks.queries import REGISTRY, WITHOUT_SQL

QUERIES = REGISTRY | WITHOUT_SQL


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in data]
    return [columns[i] for i in order], sorted(table, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark: SparkSession, connection, folder: str, name: str) -> str:
    """Empty if the query's columns and rows equal its SQL's."""
    start = time.time()
    df = QUERIES[name](spark, folder)
    columns, mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    print(f"     {name} spark {time.time() - start:.1f}s", end=" ", flush=True)
    if name not in ORACLE:
        return "" if mine else "no rows"
    result = connection.execute(ORACLE[name])
    wanted_columns, theirs = _sorted([d[0] for d in result.description], result.fetchall())
    if columns != wanted_columns:
        return f"columns differ: {sorted(set(columns) ^ set(wanted_columns))}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, SQL has {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return "rows differ: " + ", ".join(f"{c}: {x!r} | {y!r}" for c, x, y in zip(columns, a, b) if x != y)
    return ""


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = with_settings(
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
