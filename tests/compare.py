"""Run registered queries beside their SQL in DuckDB: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"d{value}"
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def check(spark, con, name, run, sql, sf_dir):
    """(rows, seconds, problem or None)"""
    start = time.time()
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return len(rows), took, None if rows else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return len(rows), took, f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, want = bag(df.columns, rows), bag(columns, expected)
    if got != want:
        extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
        return len(rows), took, (
            f"{len(rows)} rows against {len(expected)}; only Spark {extra}; only SQL {lost}"
        )
    return len(rows), took, None


def main() -> int:
    from recordloom.session import local_session
    from workload import ORACLES, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session("8"), oracle(f"/root/testdata/sf{sf}")
    bad = 0
    for name in names:
        try:
            rows, took, problem = check(
                spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir
            )
        except Exception as error:  # report and go on with the next query
            rows, took, problem = 0, 0.0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if name in ORACLES else "rows")
        print(f"{mark:5}{name:28}{rows:9} rows {took:7.2f} s  {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
