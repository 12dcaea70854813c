"""Run queries beside their SQL and report every difference.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if (Path(folder) / f"{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.date().isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _order(row):
    return [(value is None, type(value).__name__, value) for value in row]


def _normal(columns, rows):
    """Columns by name, rows in a fixed order, plain values."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in places) for row in rows]
    return [columns[i] for i in places], sorted(table, key=_order)


def differences(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What separates a Spark result from a DuckDB result; empty when equal in value and type."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want_cols, want = _normal(names, found.fetchall())
    got_cols, have = _normal(got.columns, [tuple(r) for r in got.collect()])
    if want_cols != got_cols:
        return [f"columns {got_cols} != {want_cols}"]
    if len(want) != len(have):
        return [f"{len(have)} rows != {len(want)}"]
    bad = []
    for a, b in zip(have, want):
        for column, x, y in zip(got_cols, a, b):
            if x != y or type(x) is not type(y):
                bad.append(f"{column}: {x!r} != {y!r}")
    return bad[:8] + ([f"... {len(bad)} cells differ"] if len(bad) > 8 else [])


def main(argv: list[str]) -> int:
    from checks.oracle import ORACLES, over_test_tables
    from groundburn.registry import QUERIES
    from groundburn.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session(8), connect(folder)
    failures = 0
    for name in names:
        start = time.perf_counter()
        try:
            if name in ORACLES:
                bad = differences(QUERIES[name](spark, folder), con, over_test_tables(ORACLES[name]))
            else:
                bad = []
                print(f"-- {name}: no SQL, {len(QUERIES[name](spark, folder).collect())} rows")
        except Exception as error:  # report and go on with the others
            bad = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failures += bool(bad)
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.perf_counter() - start:.2f}s", flush=True)
        for line in bad:
            print("     ", line)
    print(f"{len(names) - failures} of {len(names)} agree")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
