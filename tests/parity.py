"""Compare every query with its SQL check: python tests/parity.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def spark_rows(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    rows = frame.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(_plain(v) for v in row) for row in rows)


def oracle_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    found = connection.execute(sql)
    columns = [d[0] for d in found.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in found.fetchall())
    return [columns[i] for i in order], rows


def main() -> int:
    import __spark_entry__ as entry
    from newsmart.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, connection, bad = local_session("8"), connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            names, got = spark_rows(run(spark, sf_dir))
            took = time.time() - began
            if name not in oracles:
                print(f"rows-only {name}: {sum(got.values())} rows, {took:.1f}s", flush=True)
                continue
            expected_names, expected = oracle_rows(connection, oracles[name])
            if names == expected_names and got == expected:
                print(f"ok   {name}: {sum(got.values())} rows, {took:.1f}s", flush=True)
                continue
            bad += 1
            print(f"FAIL {name}: {sum(got.values())} vs {sum(expected.values())} rows", flush=True)
            print("  columns", names, expected_names)
            for row in list((got - expected).items())[:2]:
                print("  spark only ", str(row)[:1500])
            for row in list((expected - got).items())[:2]:
                print("  oracle only", str(row)[:1500])
        except Exception as problem:
            bad += 1
            print(f"FAIL {name}: {type(problem).__name__} {str(problem)[:1200]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
