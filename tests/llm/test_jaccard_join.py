import random
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm.components import components
from plumbline.llm.jaccard_join import band_starts, differences, least_difference, signatures_of, similar_documents, sketches

SCHEMA = "doc_id long, text string, n long, cluster string"


def element_set(text, width=3):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_force(rows, share=(9, 10), width=3):
    """doc_id: (size, smallest id reachable, number of links)."""
    sets = [(i, element_set(t, width)) for i, t in rows]
    low, links = {i: i for i, _ in sets}, defaultdict(int)
    pairs = []
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and share[1] * len(a & b) >= share[0] * len(a | b):
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    return {i: (len(s), low[i], links[i]) for i, s in sets}


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in similar_documents(df, **options).collect()}


def corpus(seed, n=160):
    """Families of near copies around the threshold, of sizes from a few words to hundreds."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, next_id = [], 0
    while next_id < n:
        base = draw.choices(vocabulary, k=draw.choice([1, 2, 3, 5, 11, 14, 24, 60, 200, 400]))
        for _ in range(draw.choice([1, 2, 3, 8])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, len(base) // 60, len(base) // 40])):
                at = draw.randrange(len(copy))
                copy[at:at + 1] = draw.choice([[], [draw.choice(vocabulary)], [copy[at], draw.choice(vocabulary)]]) if len(copy) > 1 else copy[at:at + 1]
            rows.append((next_id, draw.choice([" ", "\n", "\t "]).join(copy).replace("w1", draw.choice(["w1", "W1"]))))
            next_id += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, width, share", [(1, 3, (9, 10)), (2, 5, (4, 5))])
def test_equals_brute_force(spark, seed, width, share):
    rows = corpus(seed)
    assert found(spark, rows, width=width, share=share) == brute_force(rows, share, width)


def test_blocks_of_a_large_group(spark):
    base = [f"w{k}" for k in range(90)]
    draw = random.Random(5)
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(draw.choice([0, 1, 2, 4])):
            copy[draw.randrange(90)] = f"x{draw.randrange(30)}"
        rows.append((i, " ".join(copy)))
    assert found(spark, rows, block=7) == brute_force(rows)


def test_nulls_repeats_and_empty(spark):
    rows = [(5, None), (4, ""), (9, " \n"), (2, "a b"), (3, "A\tB"), (8, "a"), (7, "é a"), (11, "É a")]
    assert found(spark, rows) == {5: (0, 5, 0), 4: (0, 4, 0), 9: (0, 9, 0), 2: (1, 2, 1), 3: (1, 2, 1), 8: (1, 8, 0),
                                  7: (1, 7, 0), 11: (1, 11, 0)}
    assert found(spark, []) == {}
    assert found(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c")])[2][:2] == (1, 1)


@pytest.mark.parametrize("share", [(9, 10), (4, 5)])
def test_similar_sets_share_a_signature(share):
    draw = np.random.default_rng(3)
    for size in (1, 2, 3, 4, 5, 8, 9, 10, 19, 30, 77, 150, 400, 2000):
        for _ in range(40 if size < 500 else 5):
            a = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
            # As different as the bound allows: elements replaced, or only taken away.
            if draw.random() < 0.5:
                cut = size * (share[1] - share[0]) // (share[1] + share[0])
                b = np.r_[draw.choice(a, len(a) - cut, replace=False), draw.integers(0, 2**63, cut, dtype=np.uint64)]
            else:
                b = draw.choice(a, -(-size * share[0] // share[1]), replace=False)
            sig, of = signatures_of(np.r_[a, np.unique(b)], np.array([len(a), len(np.unique(b))]), share)
            assert set(sig[of == 0]) & set(sig[of == 1])


def test_bands_hold_all_partners():
    starts = band_starts((9, 10), 5000)
    most = differences((9, 10), starts)
    for a in range(1, 3000):
        band = int(np.searchsorted(starts, a, side="right")) - 1
        b = a * 10 // 9
        assert int(np.searchsorted(starts, b, side="right")) - 1 in (band, band + 1)
        shared = next(s for s in range(max(0, (9 * (a + b)) // 19 - 1), a + 1) if 10 * s >= 9 * (a + b - s)) if 10 * a >= 9 * b else a
        assert a + b - 2 * shared <= most[band]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "u long, v long").repartition(9)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_sketches_bound_differences_from_below():
    draw = np.random.default_rng(6)
    for size in (1, 5, 40, 300, 3000):
        a = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
        for kept in (0, size // 2, size):
            b = np.unique(np.r_[draw.choice(a, kept, replace=False), draw.integers(0, 2**63, size // 3, dtype=np.uint64)])
            one, two = sketches(np.r_[a, b], np.array([len(a), len(b)]))
            assert least_difference(one, two) <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))
            assert least_difference(one, one) == 0


def test_many_documents_of_one_signature(spark):
    """Groups below, at and above the size up to which pairs are judged, over several batches."""
    base = [f"b{k}" for k in range(40)]
    rows = [(g * 100 + i, " ".join([f"g{g}", *base, f"g{g}", *(["x"] if i % 2 else [])])) for g in range(3) for i in range((5, 12, 60)[g])]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (before, "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert found(spark, rows, width=5, share=(4, 5)) == brute_force(rows, (4, 5), 5)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("sizes, apart", [((95, 100, 120, 130, 140), True), ((1, 2, 3, 4, 5, 6, 40), False)])
def test_sketches_keep_similar_sets_together(sizes, apart):
    from plumbline.llm.components import forest
    from plumbline.llm.jaccard_join import near_links

    draw = np.random.default_rng(11)
    sets = []
    for n in np.repeat(sizes, 12):
        base = draw.integers(0, 2**64, n, dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.r_[base[n // 15:], draw.integers(0, 2**64, n // 12, dtype=np.uint64)])]
    counts = np.array([len(s) for s in sets], np.int64)
    held = sketches(np.concatenate(sets), counts)
    for part in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        u, v = near_links(counts, held, part, (4, 5))
        root = np.arange(len(sets))
        for node, low in zip(*forest(u, v)):
            root[node] = low
        for i, one in enumerate(sets):
            for j, two in enumerate(sets[:i]):
                shared = len(np.intersect1d(one, two))
                if 5 * shared >= 4 * (len(one) + len(two) - shared) and (part.max() == 0 or part[i] != part[j]):
                    assert root[i] == root[j]
        assert not apart or len(set(root.tolist())) >= len(sets) // 2


def test_a_large_cluster_of_unlike_sets_falls_apart(spark):
    from pyspark.sql import functions as F

    from plumbline.llm.jaccard_join import _digests, smaller_clusters

    draw = random.Random(3)
    rows = []
    for i in range(40):
        base = [f"u{draw.randrange(10**6)}" for _ in range(150)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[1:]))]
    sets = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(_digests(3), "doc_id long, n long, a long, b long, sketch binary").cache()
    band = int(np.searchsorted(band_starts((9, 10), 200), 147, side="right"))
    classes = sets.select(F.lit(0).cast("long").alias("cluster"), "n", "a", "b", F.col("doc_id").alias("rep"), F.lit(1).cast("long").alias("copies"),
                          F.lit(band).alias("band"))
    for block, wanted in ((100, {i: 0 for i in range(80)}), (16, {i: i - i % 2 for i in range(80)}), (1, {i: i - i % 2 for i in range(80)})):
        got = smaller_clusters(classes, sets, (9, 10), block).collect()
        assert {r["rep"]: r["cluster"] for r in got} == wanted and {r["whole"] for r in got} == {0}
