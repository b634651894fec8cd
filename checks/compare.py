"""Run registered queries next to their SQL on the same Parquet tables and compare."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks import load_all
from checks.catalog import ORACLES, QUERIES

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for table in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return repr(value)


def _kind(name: str) -> str:
    name = name.lower()
    groups = {
        "bigint": "bigint", "long": "bigint", "integer": "int", "int": "int", "varchar": "string",
        "string": "string", "double": "double", "date": "date", "boolean": "boolean", "bool": "boolean",
    }
    return groups.get(name, name)


def compare(spark, connection, name: str, sf_dir: str) -> tuple[str, int, float]:
    """Verdict, row count and seconds of the Spark side."""
    started = time.time()
    frame = QUERIES[name](spark, sf_dir)
    rows = frame.collect()
    seconds = time.time() - started
    if name not in ORACLES:
        return "rows-only", len(rows), seconds
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    expected = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", len(rows), seconds
    ours = {n: _kind(t) for n, t in frame.dtypes}
    wrong = {n: (ours[n], kinds[n]) for n in ours if ours[n] != kinds[n]}
    order = sorted(columns)
    left = sorted(tuple(_plain(r[c]) for c in order) for r in rows)
    right = sorted(tuple(_plain(r[columns.index(c)]) for c in order) for r in expected)
    if len(left) != len(right):
        return f"row count {len(left)} != {len(right)}", len(rows), seconds
    different = [(a, e) for a, e in zip(left, right) if a != e]
    if different:
        return f"{len(different)} rows differ, first {order}: {different[0]}", len(rows), seconds
    if wrong:
        return f"types differ: {wrong}", len(rows), seconds
    return "ok", len(rows), seconds


def main() -> int:
    from navloom.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    load_all()
    failed = 0
    for name in QUERIES:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            verdict, count, seconds = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            verdict, count, seconds = f"error {type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        failed += verdict not in ("ok", "rows-only")
        print(f"{name:38s} {count:8d} {seconds:7.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
