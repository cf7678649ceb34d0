"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network.

1. Every text is cut into runs of letters, digits and marks. A run has a sparse random index vector; a
   run's context vector is the sum of the index vectors of its neighbours over the whole corpus. Runs
   share a fixed number of rows by hash, so the vectors have one bounded size whatever the corpus.
2. A document is the weighted mean of its runs' vectors and a few shares of run kinds.
3. A network with one hidden layer learns from a bounded sample of labelled rows, on the driver, in numpy.
   A temperature fitted on rows kept aside calibrates its probabilities.
4. Every document is scored where it is read; nothing is shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.perfect_hash import mixed
from plumbline.llm.words import pieces, span_hashes, text_bytes

ROWS = 1 << 14
DIMENSIONS = 32
SLICE = 256
SAMPLE = 20_000
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3


class Runs(NamedTuple):
    first: int
    row: np.ndarray
    kind: np.ndarray
    length: np.ndarray
    upper: np.ndarray
    counts: np.ndarray


def _classes() -> np.ndarray:
    """0 white space, 1 letters and all beyond ASCII, 2 digits, 3 marks."""
    table = np.full(256, 3, np.uint8)
    table[[32, *range(9, 14)]] = 0
    table[48:58] = 2
    table[65:91] = table[97:123] = 1
    table[128:] = 1
    return table


def runs(texts: pa.Array) -> Iterator[Runs]:
    data, offsets = text_bytes(texts)
    table = _classes()
    for first, last in pieces(offsets):
        own, at = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        kind = table[own]
        edge = np.ones(len(own) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[at] = True
        bounds = np.flatnonzero(edge)
        starts, ends = bounds[:-1], bounds[1:]
        inked = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
        starts, ends = starts[inked], ends[inked]
        capital = np.cumsum(np.r_[0, (own >= 65) & (own <= 90)])
        upper = (capital[ends] - capital[starts] == ends - starts) & (ends - starts > 1)
        h = span_hashes(own, starts, ends)
        # Digits count by length alone; words in capitals are other words.
        h = np.where(kind[starts] == 2, mixed((ends - starts).astype(np.uint64)), h) ^ (upper.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        row = (mixed(h) >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)
        yield Runs(first, row, kind[starts], ends - starts, upper, np.diff(np.searchsorted(starts, at)))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For every row the two places of its index vector: +1 at the first, -1 at the second."""
    bits = mixed(np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    one = (bits % np.uint64(DIMENSIONS)).astype(np.int64)
    two = (one + 1 + ((bits >> np.uint64(20)) % np.uint64(DIMENSIONS - 1)).astype(np.int64)) % DIMENSIONS
    return one, two


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's context sums and row counts, as slices of rows."""
    plus, minus = index_vectors()
    total = np.zeros(ROWS * DIMENSIONS)
    count = np.zeros(ROWS)
    for batch in batches:
        for r in runs(batch.column(0)):
            if not len(r.row):
                continue
            count += np.bincount(r.row, minlength=ROWS)
            doc = np.repeat(np.arange(len(r.counts)), r.counts)
            near = doc[1:] == doc[:-1]
            for own, other in ((r.row[1:][near], r.row[:-1][near]), (r.row[:-1][near], r.row[1:][near])):
                total += np.bincount(own * DIMENSIONS + plus[other], minlength=ROWS * DIMENSIONS)
                total -= np.bincount(own * DIMENSIONS + minus[other], minlength=ROWS * DIMENSIONS)
    table = np.concatenate([total.reshape(ROWS, DIMENSIONS), count[:, None]], axis=1)
    parts = [table[i:i + SLICE].tobytes() for i in range(0, ROWS, SLICE)]
    yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], names=["part", "sums"])


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SLICE * (DIMENSIONS + 1))
    for x in parts["sums"]:
        total += np.frombuffer(x)
    return pd.DataFrame({"part": [int(parts["part"].iloc[0])], "sums": [total.tobytes()]})


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vectors over all texts: ROWS x DIMENSIONS, each weighted for pooling. Their size does not grow."""
    sums = (docs.select(text_col).mapInArrow(_contexts, "part long, sums binary")
            .groupBy("part").applyInPandas(_added, "part long, sums binary").collect())
    if not sums:
        return np.zeros((ROWS, DIMENSIONS), np.float32)
    table = np.concatenate([np.frombuffer(r["sums"]) for r in sorted(sums, key=lambda r: r["part"])]).reshape(ROWS, DIMENSIONS + 1)
    vectors, count = table[:, :-1], table[:, -1:]
    length = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    share = count / max(1.0, count.sum())
    return (vectors / np.maximum(length, 1) * (1e-3 / (1e-3 + share)) ** 0.5).astype(np.float32)


def features(r: Runs, vectors: np.ndarray) -> np.ndarray:
    """A row for each text; a text without runs is all zeros."""
    n = len(r.counts)
    has = r.counts > 0
    out = np.zeros((n, DIMENSIONS * 2 + 8), np.float32)
    if not len(r.row):
        return out
    begin = (np.cumsum(r.counts) - r.counts)[has]
    size = r.counts[has].astype(np.float32)[:, None]
    own = vectors[r.row]
    mean = np.add.reduceat(own, begin, axis=0) / size
    out[has, :DIMENSIONS] = mean
    out[has, DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(np.add.reduceat(own * own, begin, axis=0) / size - mean ** 2, 0))
    add = lambda x: np.add.reduceat(x.astype(np.float32), begin)[:, None] / size
    doc = np.repeat(np.arange(n), r.counts)
    distinct = np.bincount(np.unique(doc * ROWS + r.row) // ROWS, minlength=n)[has].astype(np.float32)[:, None]
    out[has, 2 * DIMENSIONS:] = np.hstack([
        add(r.kind == 2), add(r.kind == 3), add(r.upper), add(r.length) / 10, add(r.length > 12), distinct / size,
        np.log1p(size) / 8, np.ones_like(size)])
    return out


class Network(NamedTuple):
    """Scaling, two layers and a temperature."""

    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.centre) / self.spread @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, aside: np.ndarray, seed: int = 7) -> Network:
    """Adam on log loss over the rows not kept aside; the temperature that fits the rows kept aside best.

    With labels of one kind, or none, every score is the smoothed share of label 1 (a half without labels).
    """
    n_features = x.shape[1]
    use = ~aside if (~aside).sum() else np.ones(len(y), bool)
    kinds = np.unique(y[use]) if len(y) else []
    if len(kinds) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(n_features), np.ones(n_features), np.zeros((n_features, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(share / (1 - share))), 1.0)
    draw = np.random.default_rng(seed)
    centre, spread = x[use].mean(axis=0), x[use].std(axis=0) + 1e-3
    z, t = ((x[use] - centre) / spread).astype(np.float64), y[use].astype(float)
    p = [draw.normal(0, np.sqrt(2 / n_features), (n_features, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    m, v, step, batch = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0, 64
    for _ in range(max(EPOCHS, min(400, 60_000 // max(1, len(t))))):
        order = draw.permutation(len(t))
        for i in range(0, len(t), batch):
            own = order[i:i + batch]
            before = z[own] @ p[0] + p[1]
            hidden = np.maximum(before, 0)
            off = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3][0], -30, 30))) - t[own]) / len(own)
            back = np.outer(off, p[2]) * (before > 0)
            grads = [z[own].T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ off + 1e-4 * p[2], np.array([off.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 0.003 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(centre, spread, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if not aside.any():
        return net
    raw, truth = net.logits(x[aside]), y[aside].astype(float)
    def loss(heat):
        return float(np.mean(np.logaddexp(0, raw / heat) - truth * raw / heat))
    return net._replace(temperature=float(min(np.geomspace(0.25, 8, 60), key=loss)))


def _pooled(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in runs(batch.column(0)):
                rows = [x.tobytes() for x in features(r, vectors.value)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(r.first, len(rows)) for c in batch.columns[1:]] + [pa.array(rows, pa.binary())], names=["bucket", "label", "features"])

    return run


def _scored(vectors, network, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [network.value.probabilities(features(r, vectors.value)) for r in runs(batch.column(batch.schema.get_field_index(text_col)))]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score.astype(np.float64))], names=[*batch.schema.names, "__score"])

    return run


def id_bucket(column):
    """crc32 of the id as text."""
    return F.crc32(column.cast("string").cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample: int = SAMPLE) -> DataFrame:
    """The rows of docs with `__score`, the calibrated probability of label 1, from the text alone.

    The network sees at most `sample` labelled ids, those of the smallest id hash, and never one whose
    crc32 is divisible by five. Of those it keeps a fifth aside for the temperature. Ids labelled more than once use
    their smallest label; null ids and labels are not learnt from. Null and empty texts get the score of
    a text without words. Repeated rows get one score each, equal. Without labels of both kinds scores
    are constant. An empty table gives no rows. All columns pass through; names that begin with two
    underscores are reserved.
    """
    spark = docs.sparkSession
    table = word_vectors(docs, text_col)
    vectors = spark.sparkContext.broadcast(table)
    crc = id_bucket(F.col("__id"))
    chosen = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__label"))
              .where(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & (crc % 5 != 0))
              .groupBy("__id").agg(F.min("__label").alias("__label")).orderBy(F.xxhash64("__id"), "__id").limit(sample))
    # Bounded by the sample, so it goes to every task.
    known = (docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
             .join(F.broadcast(chosen), "__id").select("__text", crc.alias("bucket"), "__label")
             .mapInArrow(_pooled(vectors), "bucket long, label int, features binary")
             .groupBy("bucket", "label", "features").count().orderBy("bucket", "features").collect())
    x = np.array([np.frombuffer(r["features"], np.float32) for r in known]).reshape(len(known), DIMENSIONS * 2 + 8)
    y = np.array([r["label"] for r in known], np.int64)
    aside = np.array([r["bucket"] // 5 % 5 == 0 for r in known], bool)
    network = spark.sparkContext.broadcast(train(x, y, aside))
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(_scored(vectors, network, text_col), f"{fields}, __score double")
