"""Run named queries next to their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if value != value else value
    if hasattr(value, "item"):
        return normal(value.item())
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """What differs, or None; values must be equal, doubles and types included."""
    got_rows = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got, want = rows_of(spark_df.columns, got_rows), rows_of(names, want_rows)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {got[:2]} {want[:2]}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{g} != {w}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from obsloom.session import local_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), open_duckdb(sf_dir)
    bad = 0
    for name, run in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle_sql():
                problem = differences(df, con, oracle_sql()[name])
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} failed")
    sys.exit(bad > 0)
