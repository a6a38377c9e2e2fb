"""Compare every registered query with its reference SQL: python tests/oracle_check.py [sf_dir] [names...]."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(value))
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return str(value)


def normalized(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str:
    """Empty text when both give the same columns and the same multiset of rows."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = normalized(columns, result.fetchall())
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(want)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    from tariffscope.plans.queries import oracle_sql, queries
    from tariffscope.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con, failed = local_session(8), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("OFF")
    sqls = oracle_sql()
    for name, build in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        failed += bool(problem) and not problem.startswith("rows only")
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
