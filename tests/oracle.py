"""Run registered queries beside their SQL and compare: python tests/oracle.py [sf] [name ...]."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_plain(item) for item in value)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql) -> str | None:
    """None when equal, otherwise what differs."""
    got_columns, got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want_columns, want = rows_of([item[0] for item in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} <> {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} <> {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{mine} <> {theirs}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from triplens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false"}
    spark = build_session(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                diff = compare(df, con, sqls[name])
                state = "ok" if diff is None else f"DIFF {diff[:400]}"
            else:
                state = f"rows-only {df.count()}"
        except Exception as error:  # noqa: BLE001
            state = f"ERROR {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {state}", flush=True)
