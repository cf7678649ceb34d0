"""Shards with equal load: vector bin packing of groups of rows.

Rows are digested to a group hash and a load vector (bytes, tokens, rows). Groups are hashed into a
fixed number of bins of groups, far more than there are shards; a group heavier than a fraction of a
shard is split into parts of its own. The bins and parts are the items that are placed, heaviest
first, each into the shard where the dot product of its vector with the residual capacity is
highest. What is placed is bounded by the parameters, not by the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import stored

BINS_PER_SHARD = 256
HEAVY_PARTS_PER_SHARD = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """One row per input row: id, group (hash of the text), size, tokens, text_crc32. A null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("group"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.size(F.split(F.trim(text), "\\s+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def place(loads: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item. loads: one row per item, columns are the dimensions to balance.

    Every dimension is scaled to a share of one shard's fair load, so that residual capacities are
    comparable. The first column counts as the one to keep closest: a shard must have the room left
    there that the item needs, as long as any shard has it.
    """
    fair = np.maximum(loads.sum(axis=0) / shards, 1e-9)
    items = loads / fair
    residual = np.ones((shards, items.shape[1]))
    found = np.zeros(len(items), dtype=np.int64)
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        fits = residual[:, 0] >= items[i, 0]
        score = residual @ items[i]
        # Without room anywhere the item goes where most is left of the first dimension.
        best = int(np.argmax(np.where(fits, score, -np.inf))) if fits.any() else int(np.argmax(residual[:, 0]))
        found[i] = best
        residual[best] -= items[i]
    return level(loads[:, 0], found, shards)


def level(load: np.ndarray, found: np.ndarray, shards: int) -> np.ndarray:
    """Moves an item from the fullest to the emptiest shard, or swaps two, while that brings the two closer."""
    totals = np.bincount(found, weights=load, minlength=shards)
    for _ in range(20 * shards):
        top, low = int(np.argmax(totals)), int(np.argmin(totals))
        gap = totals[top] - totals[low]
        high_items, low_items = np.flatnonzero(found == top), np.flatnonzero(found == low)
        if gap <= 0 or not len(high_items):
            break
        # What the fuller one gives, less what it gets back (nothing, or an item), should be half the gap.
        back = np.r_[0.0, load[low_items]]
        order = np.argsort(back, kind="stable")
        at = np.clip(np.searchsorted(back[order], load[high_items] - gap / 2), 1, len(back) - 1) if len(back) > 1 else np.zeros(len(high_items), int)
        choices = [(abs(load[h] - back[order[j]] - gap / 2), int(h), int(order[j])) for h, k in zip(high_items, at) for j in {max(k - 1, 0), k}]
        off, item, other = min(choices)
        moved = load[item] - back[other]
        if not 0 < moved < gap:
            break
        found[item] = low
        if other:
            found[low_items[other - 1]] = top
        totals[top] -= moved
        totals[low] += moved
    return found


def assign_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                  overhead: int = 16, bins_per_shard: int = BINS_PER_SHARD) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row.

    Law `bytes`: the shards' sizes are near equal; tokens and rows are balanced as far as that
    leaves room. Rows of one text stay in one shard unless they weigh more than 1/64 of it; such a
    group is split by id. Slots run without gaps from 0 within a shard, by item, then id and
    checksum; repeated rows take different slots. Null texts count as empty ones, null ids sort first, other
    columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = stored(digests(docs, id_col, text_col, overhead), "shard-digests")
    groups = rows.groupBy("group").agg(F.sum("size").alias("g_size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1.0, total / shards / HEAVY_PARTS_PER_SHARD)
    # At most shards x 64 groups can weigh more than the limit.
    heavy = stored(groups.where(F.col("g_size") > limit)
                   .withColumn("parts", F.ceil(F.col("g_size") / limit).cast("int")).select("group", "parts"), "shard-heavy")
    n_bins = shards * bins_per_shard
    itemised = stored(
        rows.join(F.broadcast(heavy), "group", "left").withColumn(
            "item",
            F.when(F.col("parts").isNull(), F.pmod("group", F.lit(n_bins)).cast("long")).otherwise(
                # A part of a heavy group: beyond the bins, by group and by a slice of its ids.
                F.lit(n_bins) + F.pmod(F.xxhash64("group", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("parts"))),
                                       F.lit(2**40))),
        ).drop("parts", "group"), "shard-items")
    # Bounded: n_bins bins and at most 2 x 64 x shards parts.
    items = itemised.groupBy("item").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).toPandas()
    items = items.sort_values("item", ignore_index=True)
    items["shard"] = place(items[["size", "tokens", "rows"]].to_numpy(dtype=float).reshape(-1, 3), shards)
    items["first"] = items.groupby("shard")["rows"].cumsum() - items["rows"]
    placed = spark.createDataFrame(items[["item", "shard", "first"]].astype("int64"), "item long, shard long, first long")
    order = Window.partitionBy("item").orderBy("doc_id", "text_crc32", "size")
    return itemised.join(F.broadcast(placed), "item").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.row_number().over(order) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
