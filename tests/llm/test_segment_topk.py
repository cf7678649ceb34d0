import numpy as np

from plumbline.llm.segment_topk import RESOLUTIONS, statistics, top_k

SCHEMA = "vec_id long, embedding array<float>, block string"


def brute_force(rows, queries, k):
    good = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for q, a in good:
        if q in queries:
            scores = sorted(((-int(a @ b), i) for i, b in good if i != q and len(a) == len(b)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def found(spark, rows, queries, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)
    got = top_k(df, df.where(df["vec_id"].isin(list(queries))), **options)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


def test_equals_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(0, 0.2, 64) * (1 + i % 3)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)]
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 64), (2003, [float("inf")] * 64), (2004, [0.5] * 3), (2005, [0.25] * 3), (2006, []), (None, [0.1] * 64)]
    queries = set(range(0, 2010, 20)) | {2004}
    assert found(spark, rows, queries, query_block=8, row_block=50) == brute_force(rows, queries, 20)
    assert found(spark, rows, queries, k=3) == brute_force(rows, queries, 3)


def test_fewer_rows_than_asked_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, -1.0])]
    assert found(spark, rows, {0}) == [(0, 1, 1, 64 * 64 * 5), (0, 2, 2, -64 * 64 * 2)]
    assert found(spark, [], {0}) == []


def test_bounds_hold():
    draw = np.random.default_rng(4)
    x, y = draw.normal(0, 10, (2, 200, 50))
    for segments in RESOLUTIONS:
        assert (statistics(x, segments) @ statistics(y, segments).T >= x @ y.T - 1e-6).all()
