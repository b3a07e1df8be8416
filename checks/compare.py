"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.registry import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(v) -> str:
    return repr(float(v)) if isinstance(v, float) else str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
         "DATE": "date", "BOOLEAN": "boolean"}


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> tuple[str, float, float]:
    start = time.time()
    df = queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    spark_time = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(got)})", spark_time, 0.0
    start = time.time()
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    kinds = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    sql_time = time.time() - start
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(set(names) ^ set(df.columns))}")
    else:
        for column, kind in df.dtypes:
            if KINDS.get(kinds[column]) != kind:
                problems.append(f"type of {column}: {kind} / {kinds[column]}")
        a, b = rows_of(df.columns, got), rows_of(names, want)
        if len(a) != len(b):
            problems.append(f"rows {len(a)} / {len(b)}")
        elif a != b:
            wrong = [(x, y) for x, y in zip(a, b) if x != y]
            problems.append(f"{len(wrong)} rows differ, columns {sorted(names)}, e.g.\n    {wrong[0][0]}\n    {wrong[0][1]}")
    return ("; ".join(problems) or f"ok ({len(got)} rows)"), spark_time, sql_time


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    failed = 0
    for name in names:
        try:
            verdict, a, b = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            verdict, a, b = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0.0, 0.0
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {a:6.2f}s {b:6.2f}s  {verdict}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
