import numpy as np
from pyspark.sql import functions as F

from plumbline.llm.quality import DIMENSIONS, THRESHOLD, quality_scores, train

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_scores(docs, labels)
    assert scored.columns == [*docs.columns, "__score"]
    rows = scored.join(labels, "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()
    right = [(r["__score"] >= THRESHOLD) == (r["quality"] == 1) for r in rows]
    assert np.mean(right) >= 0.9
    good = [r["__score"] >= THRESHOLD for r in rows if r["quality"] == 1]
    assert np.mean(good) >= 0.97


def test_only_the_text_counts(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    # Held-out labels are never learnt from.
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["__score"] for r in quality_scores(docs, labels).collect()}
    b = {r["doc_id"]: r["__score"] for r in quality_scores(docs.withColumn("lang", F.lit("xx")), other).collect()}
    assert a == b


def test_nulls_empty_texts_and_missing_labels(spark):
    rows = [(1, "plain words here"), (2, None), (3, ""), (4, "x" * 300_000), (None, "!!"), (1, "plain words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    got = quality_scores(docs, none).collect()
    assert len(got) == 6 and {round(r["__score"], 6) for r in got} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id long, quality int")
    got = quality_scores(docs, one).collect()
    assert len(got) == 6 and all(0 <= r["__score"] <= 1 for r in got)
    assert quality_scores(docs.limit(0), one).collect() == []


def test_temperature_calibrates():
    draw = np.random.default_rng(0)
    x = draw.normal(0, 1, (2000, DIMENSIONS * 2 + 8)).astype(np.float32)
    p = 1 / (1 + np.exp(-1.5 * x[:, 0]))
    y = (draw.random(2000) < p).astype(int)
    net = train(x, y, np.arange(2000) % 5 == 0)
    found = net.probabilities(x[np.arange(2000) % 5 == 0])
    assert abs(found.mean() - y.mean()) < 0.08 and net.temperature > 0
