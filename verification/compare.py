"""Run queries and their SQL side by side and report differences.

    python -m verification.compare [sf folder] [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from forecourt.session import local_session
from verification.oracle import all_oracles
from verification.queries import all_queries

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        db.execute(f"create view {name} as select * from '{path}'")
    return db


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; whole floats as they are."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=repr)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def difference(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None when columns, types of values and all values agree."""
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    want = canonical(names, cursor.fetchall())
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if repr(g) != repr(w)]
    if wrong:
        g, w = wrong[0]
        cells = [
            (c, a, b) for c, a, b in zip(sorted(names), g, w, strict=True) if repr(a) != repr(b)
        ]
        return f"{len(wrong)} of {len(got)} rows differ, first in {cells[:4]} of {g[:3]}"
    return None


def main(sf_dir: str, prefixes: list[str]) -> int:
    spark = local_session("compare")
    db, oracles, failed = connect(sf_dir), all_oracles(), 0
    for name, query in all_queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            found = difference(query(spark, sf_dir), db, oracles[name])
        except Exception as error:  # report and go on with the other queries
            found = f"{type(error).__name__}: {str(error)[:300]}"
        failed += found is not None
        print(f"{name:28s} {time.time() - started:6.1f}s {found or 'ok'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]) > 0)
