"""Compare registered queries with their SQL in DuckDB: columns, row counts, every value."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.plans.catalog import QUERIES  # noqa: E402
from plumbline.plans.oracle import CASES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def shape(kind: str) -> str:
    kind = kind.lower()
    names = {"bigint": "long", "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp", "hugeint": "hugeint"}
    return names.get(kind, kind.replace(" ", ""))


def value(v):
    if isinstance(v, Decimal):
        return ("dec", str(v))
    return (type(v).__name__, v)


def compare(spark, db, name: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    df = QUERIES[name](spark, folder)
    theirs = db.execute(CASES[name])
    columns = [d[0] for d in theirs.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    expected_kinds = {d[0]: shape(str(d[1])) for d in theirs.description}
    kinds = {c: shape({"bigint": "bigint"}.get(k, k)) for c, k in df.dtypes}
    if bad := {c: (kinds[c], expected_kinds[c]) for c in columns if kinds[c] != expected_kinds[c]}:
        return f"types (ours, sql) {bad}"
    order = sorted(columns)
    rows = [dict(zip(columns, r)) for r in theirs.fetchall()]
    expected = Counter(tuple(value(r[c]) for c in order) for r in rows)
    actual = Counter(tuple(value(r[c]) for c in order) for r in df.collect())
    if actual != expected:
        ours, sql = list((actual - expected).items())[:3], list((expected - actual).items())[:3]
        return f"rows {sum(actual.values())} vs {sum(expected.values())}; only ours {ours}; only sql {sql}"
    return None if rows else "no rows"


if __name__ == "__main__":
    from plumbline.session import local_session

    session = local_session(8)
    folder = sys.argv[1]
    database = connect(folder)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = compare(session, database, name, folder) if name in CASES else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {name} {problem or ''}"[:1500], flush=True)
    print(f"{failed} failed")
