"""Run registered queries beside their SQL and compare schema and values: python -m checks.compare [folder] [names...]"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.date() if value.time() == datetime.time() else value
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, run, sql: str, folder: str) -> str:
    df = run(spark, folder)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = rows_of(names, cursor.fetchall())
    simple = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}
    odd = {n: (kinds[n], t) for n, t in df.dtypes if simple.get(kinds[n], kinds[n]) != t}
    if len(got) != len(want):
        return f"rows differ: {len(got)} against {len(want)}; types {odd}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}; types {odd}"
    return f"types differ {odd}" if odd else ""


def main(folder: str, names: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or list(QUERIES):
        begin = time.time()
        try:
            if name in ORACLE:
                problem = compare(spark, con, QUERIES[name], ORACLE[name], folder)
            else:
                problem = "" if QUERIES[name](spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - a report line per query is the point
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        state = "ok  " if not problem else "FAIL"
        print(f"{state} {name:40s} {time.time() - begin:6.2f}s {'' if name in ORACLE else '(rows only) '}{problem[:900]}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    data = arguments[0] if arguments else "/root/testdata/sf0.01"
    sys.exit(1 if main(data, arguments[1:]) else 0)
