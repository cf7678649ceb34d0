import random
from collections import Counter
from hashlib import sha256

import pytest

from conftest import SMALL, plan_of
from plumbline.llm import bloom_dedup
from plumbline.llm.bloom_dedup import exact_copies

SCHEMA = "doc_id long, text string, id string, row string, sha long, block string, group_size int"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        hashed = sha256(text.encode()).hexdigest()
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0))):
            out[i, keep, len(ids), k == len(ids) - 1, hashed] += 1
    return out


def found(spark, rows, parts=4, **options):
    df = spark.createDataFrame([(i, t, "a", "b", 1, "c", 2) for i, t in rows], SCHEMA).repartition(parts)
    return Counter(tuple(r) for r in exact_copies(df, **options).collect())


def cases():
    draw = random.Random(3)
    rows = [(i, f"Text number {draw.randrange(700)}") for i in range(1500)]
    rows += [(2000 + i, "A hot TEXT" if i % 2 else "a hot text") for i in range(900)]
    rows += [(3000, None), (3001, ""), (3002, None), (3003, "Ärger"), (3004, "ärger"), (3005, "ÄRGER"), (3006, "K"), (3007, "k"), (3008, "K"), (3009, "İ"), (3010, "i̇")]
    rows += [(None, "A hot text"), (None, "only without id"), (None, "ONLY without id"), (None, None)]
    rows += [(4000, "same row"), (4000, "same row"), (4000, "other text"), (4001, "same row"), (4000, "SAME ROW")]
    rows += [(5000, "Long " * 300_000), (5001, "lonG " * 300_000), (5002, "long " * 300_000 + "x")]
    return rows


@pytest.mark.parametrize("options", [{}, {"bits": 1}, {"filter_bytes": 4096, "bits": 48}])
def test_equals_brute_force(spark, options):
    rows = cases()
    got = found(spark, rows, **options)
    assert got == brute_force(rows)
    assert sum(n for r, n in got.items() if r[3]) == len({(t or "").translate(LOWER) for _, t in rows})


def test_empty_table_and_single_rows(spark):
    assert found(spark, []) == Counter()
    assert found(spark, [(None, None)]) == brute_force([(None, None)])


def test_most_rows_without_a_copy_pass_straight_through(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "concat('text ', if(id < 19000, id, id % 10)) as text")
    narrow = bloom_dedup.digests(rows).selectExpr("*", "pmod(xxhash64(sha), 5) as block")
    probed = bloom_dedup.possibly_repeated(narrow, bloom_dedup.hit_twice(narrow))
    flags = {r["again"]: r["count"] for r in probed.groupBy("again").count().collect()}
    assert flags[False] > 0.9 * 19_000 and flags[True] >= 1_000


def test_built_in_functions_alone(spark):
    plan = plan_of(exact_copies(spark.read.parquet(f"{SMALL}/documents.parquet")))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "ExistingRDD" not in plan
    # The rows that pass through are scanned, probed and given out: no exchange of them.
    assert "hashpartitioning" not in plan.split("Union")[1].split("group_size")[0]
