"""The pipeline's stages against brute force, each on what its predecessor kept."""

from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from plumbline.llm.common import stored
from plumbline.llm.tokens import encoder
from test_jaccard_join import brute_force as groups_by_brute_force
from test_line_dedup import brute_force as lines_by_brute_force

SMALL = "/root/testdata/sf0.001"
COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "test-stage")
        out.append(docs)
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    assert all(df.columns == COLUMNS for df in outputs[:-1])


def test_classifier_rejects_bad_documents_alone(spark, outputs):
    before, after = dict(pairs(outputs[0])), dict(pairs(outputs[1]))
    assert all(before[i] == t for i, t in after.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good, bad = ([i for i in before if labels.get(i) == q] for q in (1, 0))
    assert sum(i in after for i in good) >= 0.97 * len(good)
    assert sum(i in after for i in bad) <= 0.5 * len(bad)


def test_lines(outputs):
    expected = sorted((i, t) for i, _, _, t in lines_by_brute_force(pairs(outputs[1]), 10))
    assert sorted(pairs(outputs[2])) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in outputs[2].collect())


def test_near_copies(outputs):
    rows = pairs(outputs[2])
    low = groups_by_brute_force(rows, (4, 5), 5)
    assert Counter(pairs(outputs[3])) == Counter((i, t) for i, t in rows if low[i][1] == i)


def test_benchmark(spark, outputs):
    items = [r["text"].lower() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = pairs(outputs[3])
    # Passages in these data stand there word for word.
    dirty = {i for i, t in rows if any(x in t.lower() for x in items)}
    assert sorted(i for i, _ in pairs(outputs[4])) == sorted(i for i, _ in rows if i not in dirty)


def test_packing(outputs):
    own = encoder(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, t in pairs(outputs[4]):
        n = len(own.encode(t or "")) // 4 + 1
        expected.update((i, k, min(2048, n - 2048 * k)) for k in range(-(-n // 2048)))
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in outputs[5].collect()) == expected


def test_run_on_rows_with_nulls(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", None, "s", 3), (3, "word " * 30_000, "en", "s", 150_000),
         (4, "one two three four five six", "en", "s", 27), (5, "one two three four five six", "en", "s", 27)],
        "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, None}
    assert sum(r["length"] for r in got if r["doc_id"] == 3) == 30_001


def test_near_copies_of_repeated_and_null_ids(spark):
    one, two, three = ("alpha beta gamma delta epsilon zeta eta", "one two three four five six seven", "red green blue black white grey pink")
    rows = [(7, one), (7, one), (7, two), (3, two), (None, three), (None, three), (None, one), (8, None), (8, None), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_copies(spark, docs.repartition(3), SMALL)
    assert got.columns == COLUMNS
    assert Counter(pairs(got)) == Counter([(7, one), (3, two), (None, three), (8, None), (9, None), (None, "")])


def test_wordless_texts_are_found_without_a_join_of_texts(spark):
    rows = [(1, "\t \x0b\n"), (1, "\t \x0b\n"), (2, "\u00a0"), (3, None), (3, None), (4, " "), (None, ""), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_copies(spark, df, "")
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(
        [(1, "\t \x0b\n"), (2, "\u00a0"), (3, None), (4, " "), (None, ""), (None, "")], key=repr)
    # Ids of the linked rows alone, in the three places where the plan has them; texts move in the last anti join.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 3
