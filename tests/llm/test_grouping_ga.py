import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from plumbline.llm.grouping_ga import best_fit, crossed, evolve, fitness, fresh, lower_bound, pack, sequences, token_pieces
from plumbline.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def is_packing(bins, lengths, size):
    return len(bins) == len(lengths) and (not len(bins) or np.bincount(bins, weights=lengths).max() <= size)


def test_bounds_and_best_fit():
    assert lower_bound(np.array([], int), 10) == 0
    assert lower_bound(np.array([6, 6, 6]), 10) == 3 and lower_bound(np.array([5, 5, 5, 5]), 10) == 2
    assert lower_bound(np.array([7, 7, 4, 4]), 10) == 3
    bins, fill = np.full(5, -1), []
    best_fit(np.arange(5), np.array([6, 4, 7, 3, 10]), bins, fill, 10)
    assert sorted(fill) == [10, 10, 10]


@pytest.mark.parametrize("seed", range(3))
def test_evolution_keeps_packings_and_improves(seed):
    draw = np.random.default_rng(seed)
    # Triples that fill a bin exactly: best fit alone wastes bins here.
    parts = draw.integers(250, 500, (150, 2))
    lengths = np.concatenate([parts.ravel(), 1000 - parts.sum(axis=1)])
    lengths = lengths[lengths > 0]
    first = fresh(lengths, 1000, None)
    child = crossed(fresh(lengths, 1000, draw), first, lengths, 1000, draw)
    assert is_packing(first, lengths, 1000) and is_packing(child, lengths, 1000)
    best = evolve(lengths, 1000, seed, [], generations=12)
    assert is_packing(best, lengths, 1000) and fitness(best, lengths, 1000) >= fitness(first, lengths, 1000)
    assert lower_bound(lengths, 1000) <= -fitness(best, lengths, 1000)[0]


def test_whole_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 9000), (-4, "twin"), (-4, "twin"), (None, "x")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(extra)
    got = pack(token_pieces(docs, PATH, with_ids=True), block=50)
    rows = got.collect()
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for parts in held.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048
    own = encoder(PATH).tokenizer
    expected = sorted(
        (str(r["doc_id"]), k, a, len(ids[a:a + 2048]))
        for r in docs.collect() for ids in [own.encode(r["text"] or "", add_special_tokens=False).ids + [0]] for k, a in enumerate(range(0, len(ids), 2048)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"]) for r in rows) == expected
    whole = {r["sequence_id"]: array("I", r["ids"]) for r in sequences(got).collect()}
    some = next(r for r in rows if r["doc_id"] == -1)
    assert whole[some["sequence_id"]][some["offset"]] == 0
    assert len(held) <= 1.1 * sum(r["length"] for r in rows) / 2048 + 2
    assert pack(token_pieces(extra.limit(0), PATH)).collect() == []
