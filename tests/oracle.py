"""Compare a registered query with its SQL twin in DuckDB, row by row.

Run directly to check queries from the command line:
    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(value) -> str:
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = df.collect()
    left, right = rows_of(df.columns, got), rows_of(names, expected)
    kinds_left = {c: {_kind(v) for v in (r[i] for r in got) if v is not None} for i, c in enumerate(df.columns)}
    kinds_right = {c: {_kind(v) for v in (r[i] for r in expected) if v is not None} for i, c in enumerate(names)}
    if kinds_left != kinds_right:
        bad = {c: (kinds_left[c], kinds_right[c]) for c in names if kinds_left[c] != kinds_right[c]}
        return f"types {bad}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"rows {sum(left.values())} vs {sum(right.values())}; "
            f"only spark {str(list(only_left)[:2])[:600]}; only sql {str(list(only_right)[:2])[:600]}"
        )
    return None


def main() -> int:
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                note = "same"
            else:
                problem, note = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem:
            failed.append(name)
        print(f"{name:32s} {time.time() - began:6.1f}s  {problem or note}", flush=True)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
