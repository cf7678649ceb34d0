"""Lines that many documents repeat, found in a sharded perfect-hash index.

1. Each document becomes the list of its distinct line hashes (128 bits). Counts are summed within
   a batch before they are shuffled, so a line of all documents is a few rows.
2. Hashes of at least two documents are dealt to shards of bounded size. Each shard is one minimal
   perfect hash with an array of fingerprints and an array of counts.
3. Documents probe the arrays: their hashes, cut up by shard, stream past the shard in one sorted
   partition. What comes back is the hashes a document loses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, stored
from plumbline.llm.perfect_hash import Lookup, build

MIN_DOCS = 10
SHARD_KEYS = 1 << 18


def line_key(line: bytes) -> bytes:
    """Without the white space at both ends, A-Z lower-cased."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def key_hashes(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text, and 16 bytes for each line's key (none for an empty key)."""
    import xxhash

    lines = text.split(b"\n")
    return lines, [xxhash.xxh3_128_digest(k) if (k := line_key(x)) else b"" for x in lines]


def _document_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            own = set(key_hashes((text or "").encode())[1])
            own.discard(b"")
            out.append(b"".join(own))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "hashes"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<i8").reshape(-1, 2)
        keys, n = np.unique(raw, axis=0, return_counts=True) if len(raw) else (raw, np.zeros(0, int))
        yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(n.astype("int64"))],
                                         names=["a", "b", "n"])


def _index_shard(keys: pd.DataFrame) -> pd.DataFrame:
    a, b = keys["a"].to_numpy(np.int64).view(np.uint64), keys["b"].to_numpy(np.int64).view(np.uint64)
    levels = build(a, b)
    slots = Lookup(levels).slots(a, b)
    prints, counts = np.zeros(len(a), np.uint64), np.zeros(len(a), np.int64)
    prints[slots] = b
    counts[slots] = keys["n"].to_numpy(np.int64)
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "levels": [levels],
                         "prints": [prints.tobytes()], "counts": [counts.tobytes()]})


def line_index(documents: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """(shard, levels, prints, counts) over all line hashes of two or more documents, and the number of shards."""
    counts = (documents.select("hashes").mapInArrow(_counts, "a long, b long, n long")
              .groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 1"))
    counts = stored(counts, "line-counts")
    shards = max(1, -(-counts.count() // shard_keys))
    shard = F.pmod("a", F.lit(shards)).cast("long").alias("shard")
    index = counts.select(shard, "a", "b", "n").groupBy("shard").applyInPandas(
        _index_shard, "shard long, levels array<binary>, prints binary, counts binary")
    return stored(index, "line-index"), shards


def _split(shards: int):
    """A document's hashes by shard: the first half of a hash, modulo the number of shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            keys = np.frombuffer(b"".join(raw), dtype="<i8").reshape(-1, 2)
            owner = np.repeat(np.arange(len(raw)), [len(x) // 16 for x in raw])
            shard = keys[:, 0] % shards
            order = np.lexsort((shard, owner))
            owner, shard, keys = owner[order], shard[order], keys[order]
            starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (shard[1:] != shard[:-1])])
            ends = np.r_[starts[1:], len(owner)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner[starts])), pa.array(shard[starts]),
                 pa.array([keys[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary())],
                names=["doc_id", "shard", "hashes"])

    return run


def _probe(min_docs: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shard = prints = counts = None
        for frame in frames:
            ids, lost = [], []
            kinds = frame["levels"].notna().to_numpy()
            # Runs of probes between index rows share one lookup.
            edges = [*np.flatnonzero(kinds), len(frame)]
            first = 0
            for edge in edges:
                part = frame.iloc[first:edge]
                if len(part):
                    if held is not None:
                        part = part[part["shard"] == shard]
                        raw = part["hashes"].tolist()
                        keys = np.frombuffer(b"".join(raw), dtype="<u8").reshape(-1, 2)
                        owner = np.repeat(np.arange(len(raw)), [len(x) // 16 for x in raw])
                        a, b = keys[:, 0].copy(), keys[:, 1].copy()
                        slots = held.slots(a, b)
                        hit = slots >= 0
                        hit[hit] = (prints[slots[hit]] == b[hit]) & (counts[slots[hit]] >= min_docs)
                        for who in np.unique(owner[hit]):
                            ids.append(part["doc_id"].iloc[who])
                            lost.append(keys[hit & (owner == who)].tobytes())
                if edge < len(frame):
                    row = frame.iloc[edge]
                    shard, held = row["shard"], Lookup(list(row["levels"]))
                    prints = np.frombuffer(row["prints"], np.uint64)
                    counts = np.frombuffer(row["counts"], np.int64)
                first = edge + 1
            yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "lost": lost})

    return run


def _rewrite(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at, last = names.index(text_col), len(names) - 1
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist()):
                raw = (text or "").encode()
                if not lost:
                    texts.append(text or "")
                    n_lines.append(raw.count(b"\n") + 1)
                    n_dropped.append(0)
                    continue
                gone = {x[i:i + 16] for x in lost for i in range(0, len(x), 16)}
                lines, keys = key_hashes(raw)
                kept = [x for x, k in zip(lines, keys) if k not in gone]
                texts.append(b"\n".join(kept).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=names[:last] + ["__n_lines", "__n_dropped"])

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                shard_keys: int = SHARD_KEYS) -> DataFrame:
    """The rows of docs with the text that is left, and `__n_lines` and `__n_dropped`.

    A null or empty text is one empty line. Empty keys are never dropped. Copies of a row count as
    documents of their own; all lose the same lines. A text that loses every line becomes empty. Null ids are an id like
    others. Other columns pass through; names that begin with two underscores are reserved. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    documents = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                       .mapInArrow(_document_hashes, "doc_id long, hashes binary"), "line-hashes")
    index, shards = line_index(documents, shard_keys)
    parts = 2 * partitions(spark)
    salts = max(1, -(-parts // shards))
    probes = (documents.where("length(hashes) > 0").mapInArrow(_split(shards), "doc_id long, shard long, hashes binary")
              .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts))))
    rows = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).unionByName(
        probes, allowMissingColumns=True)
    lost = (rows.repartition(parts, "shard", "salt")
            .sortWithinPartitions("shard", "salt", F.col("levels").isNull())
            .select("shard", "levels", "prints", "counts", "doc_id", "hashes")
            .mapInPandas(_probe(min_docs), "doc_id long, lost binary"))
    lost = lost.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list("lost").alias("__lost"))
    joined = docs.join(lost, F.col(id_col).eqNullSafe(F.col("__id")), "left").drop("__id")
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return joined.mapInArrow(_rewrite(text_col), f"{fields}, __n_lines long, __n_dropped long")
