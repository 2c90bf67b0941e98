"""Run registered queries on Spark and their oracle on DuckDB, and compare.

    python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import glob
import os
import time
from collections import Counter

import duckdb

SF_DIR = "/root/testdata/sf0.01"


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM \'{path}\'')
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_table(df):
    return table(df.columns, df.collect())


def oracle_table(con, sql):
    done = con.execute(sql)
    return table([c[0] for c in done.description], done.fetchall())


KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_differences(df, con, sql):
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    found = {c: KINDS.get(t, t.upper()) for c, t in df.dtypes}
    return {c: (found.get(c), t) for c, t in duck_types.items() if found.get(c) != t}


def compare(spark, con, name, run, sql, sf_dir):
    """(ok, message, seconds)"""
    start = time.time()
    df = run(spark, sf_dir)
    columns, rows = spark_table(df)
    seconds = time.time() - start
    want_columns, want = oracle_table(con, sql)
    if columns != want_columns:
        return False, f"columns {columns} != {want_columns}", seconds
    if rows != want:
        extra, missing = rows - want, want - rows
        return False, (
            f"{sum(rows.values())} rows against {sum(want.values())}; {sum(extra.values())} differ, e.g. "
            f"{list(extra)[:2]} for {list(missing)[:2]}"
        ), seconds
    types = type_differences(df, con, sql)
    return True, f"{sum(rows.values())} rows" + (f", types {types}" if types else ""), seconds


def main():
    from tidemark.plans import ORACLES, QUERIES
    from tidemark.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default=SF_DIR)
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    failures = 0
    for name in args.names or QUERIES:
        try:
            ok, message, seconds = compare(spark, con, name, QUERIES[name], ORACLES[name], args.sf)
        except Exception as error:  # report and go on
            ok, message, seconds = False, f"{type(error).__name__}: {str(error)[:900]}", 0.0
        failures += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:26s} {seconds:6.2f}s  {message}", flush=True)
    print(f"{failures} failures")


if __name__ == "__main__":
    main()
