import hashlib
import random
from collections import Counter

import numpy as np

from plumbline.llm.line_dedup import dedup_lines
from plumbline.llm.perfect_hash import Lookup, build

SCHEMA = "doc_id long, text string, shard string, n long"


def brute_force(rows, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    docs = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or docs[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    got = dedup_lines(df, **options)
    assert got.columns == ["doc_id", "text", "shard", "n", "__n_lines", "__n_dropped"]
    return sorted(((r["doc_id"], r["__n_lines"], r["__n_dropped"], r["text"]) for r in got.collect()), key=str)


def test_random_texts(spark):
    draw = random.Random(3)
    pool = [f"line {k}" for k in range(30)] + ["", "  ", "É", "é", "\tLINE 1 ", "a\x0b"]
    rows = [(i, "\n".join(draw.choices(pool, k=draw.randrange(12)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "line 1\nonly"), (None, None), (7, "line 2"), (7, "line 2"), (502, "x" * 300_000 + "\nline 3\n")]
    for shard_keys in (1 << 18, 7):
        assert found(spark, rows, min_docs=10, shard_keys=shard_keys) == brute_force(rows, 10)


def test_a_line_of_all_documents_and_an_empty_table(spark):
    rows = [(i, f"Same\n{i}") for i in range(300)]
    assert all(r[2:] == (1, str(r[0])) for r in found(spark, rows))
    assert found(spark, []) == []
    assert hashlib.sha256(b"").hexdigest()


def test_perfect_hash():
    draw = np.random.default_rng(5)
    a, b = draw.integers(0, 2**64, (2, 5000), dtype=np.uint64)
    a[1] = a[0]
    lookup = Lookup(build(a, b))
    assert sorted(lookup.slots(a, b)) == list(range(5000))
    assert Lookup(build(a[:0], b[:0])).slots(a, b).max() == -1
