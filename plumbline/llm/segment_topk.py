"""Exact top-k by inner product, pruned by segment statistics at several resolutions.

A vector is cut into equal segments; each keeps its mean and deviation. For a segment of length L

    distance^2 >= L * ((mean_q - mean_x)^2 + (deviation_q - deviation_x)^2)

and, as distance^2 = |q|^2 + |x|^2 - 2 q.x, a lower bound of the distance is an upper bound of the
inner product: the sum over segments of L * (mean_q * mean_x + deviation_q * deviation_x). Coarse
segments are tried first; pairs that cannot reach a query's k-th best score so far are dropped, and
only survivors get an exact product.

Queries and rows are packed into blocks of bounded size. Every block of queries meets every block of
rows in some task; a task keeps at most k rows for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, stored

K = 20
SCALE = 64
RESOLUTIONS = (1, 4, 16)
QUERY_BLOCK = 1024
ROW_BLOCK = 4096


def _pack(block: int, scale: int):
    """Blocks of (n, dim, ids, int32 vectors). Vectors that are null or hold null or non-finite components are left out."""
    def blocks(ids, vectors):
        by_size = {}
        for i, v in zip(ids, vectors):
            if i is not None and v is not None and None not in v:
                by_size.setdefault(len(v), []).append((i, v))
        for dim, rows in by_size.items():
            x = np.array([v for _, v in rows], dtype=np.float64).reshape(len(rows), dim)
            keep = np.isfinite(x).all(axis=1)
            whole = np.floor(scale * x[keep]).astype(np.int64)
            own = np.array([i for i, _ in rows], dtype=np.int64)[keep]
            for k in range(0, len(own), block):
                part = slice(k, k + block)
                yield dim, own[part].tobytes(), whole[part].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        def flush():
            made = list(blocks(ids, vectors))
            ids.clear(), vectors.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.binary()),
                 pa.array([m[2] for m in made], pa.binary())], names=["dim", "ids", "vectors"])

        for batch in batches:
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            if len(ids) >= block:
                yield flush()
        if ids:
            yield flush()

    return run


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """For every vector the scaled means and deviations of its segments; their product bounds x.y from above."""
    edges = np.linspace(0, x.shape[1], min(segments, max(1, x.shape[1])) + 1).astype(int)
    parts = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        piece, root = x[:, lo:hi], np.sqrt(max(1, hi - lo))
        mean = piece.mean(axis=1) if hi > lo else np.zeros(len(x))
        deviation = piece.std(axis=1) if hi > lo else np.zeros(len(x))
        parts += [mean * root, deviation * root]
    return np.stack(parts, axis=1)


def best_of_block(q_ids, q, x_ids, x, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): the k best rows of the block for each query, ties to the smaller row id."""
    q_float, x_float = q.astype(np.float64), x.astype(np.float64)
    slack = 1e-6 * (1 + np.abs(q_float).sum())
    bounds = [(statistics(q_float, s), statistics(x_float, s)) for s in RESOLUTIONS]
    out = []
    for row in range(len(q)):
        left = np.flatnonzero(x_ids != q_ids[row])
        reach = -np.inf
        for mine, theirs in bounds:
            bound = theirs[left] @ mine[row]
            if len(left) > k:
                # Exact scores of the rows with the best bounds set the score that others must reach.
                seeds = left[np.argpartition(-bound, k - 1)[:k]]
                reach = max(reach, (x[seeds] @ q[row]).min())
            left = left[bound >= reach - slack]
        score = x[left] @ q[row]
        top = np.lexsort((x_ids[left], -score))[:k]
        out.append((np.full(len(top), q_ids[row]), x_ids[left][top], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _compare(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, q_ids, q, x_ids, x in zip(*(c.to_pylist() for c in batch.columns)):
                found = best_of_block(
                    np.frombuffer(q_ids, np.int64), np.frombuffer(q, np.int64).reshape(-1, dim),
                    np.frombuffer(x_ids, np.int64), np.frombuffer(x, np.int64).reshape(-1, dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query, ties to the smaller id.

    Components become floor(scale * x). A row is no candidate for the query of its own id. Rows with
    a null id, a null vector or a component that is null or not finite take no part; vectors of
    different length are not compared. Repeated rows are candidates each. Fewer candidates than k
    give fewer ranks, an empty table none.
    """
    spark = rows.sparkSession
    shape = "dim long, ids binary, vectors binary"
    columns = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")]
    asked = stored(queries.select(*columns), "topk-queries")
    n_blocks = max(1, -(-asked.count() // query_block))
    asked = stored(
        asked.repartition(n_blocks, "id").mapInArrow(_pack(query_block, scale), shape)
        .withColumn("block", F.pmod(F.xxhash64("ids"), F.lit(n_blocks))), "topk-query-blocks")
    # A block of queries is copied to as many groups as keep all tasks busy; a block of rows goes to one group.
    groups = max(1, -(-partitions(spark) // n_blocks))
    held = rows.select(*columns).mapInArrow(_pack(row_block, scale), shape)
    meet = (held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
            .withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(groups).cast("long"))))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = (meet.select("dim", "block", "part", F.col("ids").alias("x_ids"), F.col("vectors").alias("x"))
             .join(asked.select("dim", "block", "part", F.col("ids").alias("q_ids"), F.col("vectors").alias("q")),
                   ["dim", "block", "part"])
             .select("dim", "q_ids", "q", "x_ids", "x"))
    found = pairs.mapInArrow(_compare(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
