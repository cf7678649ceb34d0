"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import release, stored

ROUNDS = 60


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component within these links), one for each node but the smallest."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, low[a], least)
        np.minimum.at(new, low[b], least)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    rest = low != np.arange(len(nodes))
    return nodes[rest], nodes[low[rest]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        keep = u != v
        a, b = forest(u[keep], v[keep])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])


def _settled(edges: DataFrame) -> bool:
    """True if every link is (node, root), each node has one root, and no root has a root."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("roots"), F.lit(0).alias("is_root")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("roots"), F.lit(1).alias("is_root")))
    counts = ends.groupBy("x").agg(F.sum("roots").alias("roots"), F.max("is_root").alias("is_root"))
    return counts.where("roots > 1 or (roots > 0 and is_root > 0)").isEmpty()


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component): every node that has a link to another, with the smallest node it can reach.

    links: two integer columns. Each round joins every node's links with its smallest neighbour, and
    is written out, so no plan grows and no node's neighbours are gathered anywhere.
    """
    a, b = links.columns
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    edges = stored(edges.distinct(), purpose)
    release(edges.sparkSession)
    for _ in range(ROUNDS):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # Larger neighbours of a node are tied to its smallest one.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, purpose)
        # Then a node's smaller neighbours, and the node, to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(edges.where("u <> v").mapInArrow(_thinned, "u long, v long").distinct(), purpose)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
