import random
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers
from plumbline.llm.token_files import SequenceReader, SequenceWriter, read_checksums, token_root, write_token_files
from plumbline.llm.tokens import KEPT, Encoder, encoder

SCHEMA = "doc_id long, text string, file string, at long"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(spark, name):
    own = Encoder(public_tokenizers.path(name))
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    draw = random.Random(4)
    parts = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", ".", "'s", "'", "1", "２", "ª", "µ", "<|endoftext|>", "\x1c", " ", "𝔘", "İ", "ﬁ", "é",
             "-", "don't", "!!", "\r\n", "Σ", "漢", " "]
    texts += ["".join(draw.choices(parts, k=draw.randrange(14))) for _ in range(4000)]
    for t in texts:
        assert own.encode(t) == array("I", own.tokenizer.encode(t, add_special_tokens=False).ids).tobytes(), t
    assert len(own.pieces) <= KEPT + 100_000


def brute_force(rows):
    e = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    start, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = array("I", e.tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def found(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in docs], SCHEMA).repartition(4)
    root = token_root(spark)
    index = write_token_files(df, root, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, **options)
    return sorted((tuple(r) for r in read_checksums(index, root).collect()), key=str)


def test_round_trip(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(-5, None), (10**9, ""), (10**9 + 1, "word " * 60_000), (None, "no id")]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows[:40], length=7, rows=3, files=5) == brute_force(rows[:40])


def test_repeats_and_empty(spark):
    rows = [(1, "same"), (1, "same"), (2, "x")]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, []) == []


def test_sequences_and_masks_without_copies():
    sink = pa.BufferOutputStream()
    writer = SequenceWriter(sink, pa.uint16(), 8, 4)
    ids = np.arange(101, dtype=np.uint16)
    for part in np.array_split(ids, 9):
        writer.add(part)
    writer.close()
    reader = SequenceReader(pa.BufferReader(sink.getvalue()))
    assert reader.sequence(3).tolist() == ids[24:32].tolist() and reader.mask(3).all()
    assert reader.sequence(12).tolist() == [96, 97, 98, 99, 100, 0, 0, 0] and reader.mask(12).tolist() == [True] * 5 + [False] * 3
    assert reader.ids(30, 5).tolist() == [30, 31, 32, 33, 34] and not reader.sequence(2).flags.owndata
