import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm.shard_packing import assign_shards, place

SCHEMA = "doc_id long, text string, shard string, item long"


def check(spark, rows, shards=40, even=1.05):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], SCHEMA)
    got = assign_shards(df, shards).collect()
    raw = [(i, (t or "").encode()) for i, t in rows]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len(t) + 16, zlib.crc32(t)) for i, t in raw)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if even:
        mean = sum(sizes.values()) / shards
        assert max(abs(sizes[s] - mean) for s in range(shards)) <= (even - 1) * mean
    return got


def test_even_sizes_with_a_hot_text(spark):
    draw = np.random.default_rng(1)
    rows = [(i, "word " * int(draw.integers(1, 300))) for i in range(6000)]
    rows += [(10_000 + i, "the same text of a third of all rows " * 8) for i in range(3000)]
    got = check(spark, rows, even=1.02)
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
    # The hot text is split, others stay together.
    assert len(by_text[zlib.crc32(rows[-1][1].encode()), len(rows[-1][1]) + 16]) > 5
    texts = Counter(t for _, t in rows)
    few = [t for t in texts if texts[t] < 3]
    assert all(len(by_text[zlib.crc32(t.encode()), len(t.encode()) + 16]) == 1 for t in few)


def test_nulls_repeats_and_empty(spark):
    check(spark, [(None, None), (None, "a"), (1, ""), (1, ""), (2, "é"), (3, "x" * 100_000)], even=None)
    check(spark, [], even=None)


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_place(n):
    loads = np.random.default_rng(n).uniform(1, 5, (n, 3))
    found = place(loads, 7)
    assert len(found) == n and (n < 7 or set(found) == set(range(7)))
    if n == 1000:
        totals = np.array([loads[found == s].sum(axis=0) for s in range(7)])
        assert (totals[:, 0].max() / totals[:, 0].min() < 1.001) and (totals.max(axis=0) / totals.min(axis=0) < 1.1).all()
