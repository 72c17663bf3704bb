"""Run registered queries and their SQL on the same tables and compare the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns sorted by name, rows sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def difference(df, con, sql: str) -> str | None:
    """None if the rows agree, else what differs."""
    have = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if have[0] != want[0]:
        return f"columns {have[0]} != {want[0]}"
    if len(have[1]) != len(want[1]):
        return f"{len(have[1])} rows, expected {len(want[1])}"
    for a, b in zip(have[1], want[1]):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from ratemill.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con, sql, bad = get_spark("compare", "8"), connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if name not in sql or only and name not in only:
            continue
        start = time.time()
        try:
            found = difference(run(spark, sf_dir), con, sql[name])
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {'ok' if found is None else found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
