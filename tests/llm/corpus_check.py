"""Compare a corpus query with its SQL in DuckDB: columns, row counts, every value."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from plumbline.llm.queries import CASES, QUERIES  # noqa: E402

TABLES = "documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "bigint", "integer": "int", "varchar": "string", "double": "double", "boolean": "boolean"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def compare(spark, db, name: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    df = QUERIES[name](spark, folder)
    theirs = db.execute(CASES[name])
    columns = [d[0] for d in theirs.description]
    kinds = {d[0]: KINDS[str(d[1]).lower()] for d in theirs.description}
    if kinds != dict(df.dtypes):
        return f"columns {dict(df.dtypes)} != {kinds}"
    expected = Counter(theirs.fetchall())
    actual = Counter(tuple(r[c] for c in columns) for r in df.collect())
    if actual != expected:
        return f"only ours {list((actual - expected).items())[:3]}; only sql {list((expected - actual).items())[:3]}"
    return None if actual else "no rows"


if __name__ == "__main__":
    from plumbline.session import local_session

    session = local_session(8)
    database = connect(sys.argv[1])
    for name in sys.argv[2:] or CASES:
        start = time.time()
        problem = compare(session, database, name, sys.argv[1]) if name in CASES else f"{QUERIES[name](session, sys.argv[1]).toPandas()}"
        print(f"{time.time() - start:6.1f}s {name} {problem or 'ok'}"[:3000], flush=True)
