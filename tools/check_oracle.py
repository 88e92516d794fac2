"""Runs registered queries in Spark and their SQL counterparts in DuckDB and compares the rows.

    python tools/check_oracle.py [--dir /root/testdata/sf0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from forecourt.queries import ORACLES, QUERIES  # noqa: E402
from forecourt.session import local_session  # noqa: E402
from forecourt.sources.bindings import PARQUET_TABLES  # noqa: E402


def plain(value):
    """A comparable, type-tagged form of a cell."""
    if value is None:
        return None
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("d", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("l", tuple(plain(v) for v in value))
    return (type(value).__name__, str(value))


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(frame, cursor) -> list[str]:
    """Columns whose type names do not correspond."""
    want = {d[0]: str(d[1]).upper() for d in cursor.description}
    return [
        f"{name}: {kind} / {want.get(name)}"
        for name, kind in frame.dtypes
        if SPARK_TYPES.get(kind, kind) != want.get(name)
    ]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([plain(r[i]) for i in order]) for r in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    for table in PARQUET_TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{args.dir}/{table}.parquet'")
    spark = local_session()

    bad = 0
    for name, run in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.perf_counter()
        try:
            frame = run(spark, args.dir)
            got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
            took = time.perf_counter() - start
            if name not in ORACLES:
                print(f"rows  {name:28} {len(got[1]):7} rows {took:6.2f}s")
                continue
            start = time.perf_counter()
            cursor = duck.execute(ORACLES[name])
            columns = [d[0] for d in cursor.description]
            types = type_differences(frame, cursor)
            want = rows_of(columns, cursor.fetchall())
            duck_took = time.perf_counter() - start
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}")
            continue
        same = got == want and not types
        bad += not same
        print(f"{'ok   ' if same else 'DIFF '} {name:28} {len(got[1]):7} rows {took:6.2f}s duckdb {duck_took:5.2f}s")
        if not same:
            if types:
                print("   types", types)
            if got[0] != want[0]:
                print("   columns", got[0], want[0])
            only_got = [r for r in got[1] if r not in set(want[1])]
            only_want = [r for r in want[1] if r not in set(got[1])]
            print(f"   spark {len(got[1])} rows, duckdb {len(want[1])} rows")
            print("   only spark ", only_got[:3])
            print("   only duckdb", only_want[:3])
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
