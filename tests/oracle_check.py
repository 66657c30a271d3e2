"""Compare registered queries with their SQL twins: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def kinds(rows):
    seen: dict[int, set] = {}
    for row in rows:
        for i, v in enumerate(row):
            if v is not None:
                seen.setdefault(i, set()).add(type(v).__name__)
    return seen


def differences(spark, con, folder: str, name: str, build, sql: str) -> str | None:
    """None when equal, else a short description."""
    df = build(spark, folder)
    mine = ordered(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    theirs = ordered([d[0] for d in rel.description], rel.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} vs {len(theirs[1])}"
    if kinds(mine[1]) != kinds(theirs[1]):
        return f"types {kinds(mine[1])} vs {kinds(theirs[1])} in {mine[0]}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine[1])} rows differ, first {mine[0]}\n    {bad[0][0]}\n    {bad[0][1]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from claimlake.session import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    data = f"/root/testdata/sf{scale}"
    session = build_session("oracle-check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    con = connect(data)
    failures = 0
    for name, build in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"ROWS {name}: {build(session, data).count()} ({time.time() - start:.1f}s)", flush=True)
                continue
            problem = differences(session, con, data, name, build, sql)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'OK  '} {name} ({time.time() - start:.1f}s) {problem or ''}", flush=True)
    print("failures:", failures)
    session.stop()
