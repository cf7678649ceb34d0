"""Digest trees: checksums of a table by leaf of its key hash, kept beside the rows and kept up to date.

A leaf is a share of the keys; a fixed number of leaves make a bucket. A tree has one row per leaf with its row count and checksum
lanes, so its size does not grow with the table. Lanes are sums: what a load adds and what it replaces are added and taken away, and the table
need not be read again. Two stored versions are compared by their trees, and only the rows of leaves that differ are opened.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.digest import BUCKETS, key_bucket, row_text_sql
from plumbline.operators.checksum import COMPARED, bands_differ, differing_rows
from plumbline.operators.profile import hashed_rows, profile_aggregates
from plumbline.session import read_text, write_text

LEAVES = 64
LEAF, BUCKET = "_leaf", "_bucket"


def key_leaf(df: DataFrame, keys: list[str], buckets: int = BUCKETS, leaves: int = LEAVES) -> Column:
    """Number of a row's leaf: those of a bucket follow each other."""
    place = f"cast(conv(substring(md5({row_text_sql(df, keys)}), 9, 8), 16, 10) as bigint) % {leaves}"
    return (key_bucket(df, keys, buckets) * leaves + F.expr(place)).cast("int")


def tree(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS, leaves: int = LEAVES) -> DataFrame:
    """Rows ``(leaf, n, lane0, lane1, lane2)`` of the leaves that have rows, from one scan.

    A task sends at most one row per leaf, however its keys are spread.
    """
    rows = hashed_rows(df, columns, [], key_leaf(df, keys, buckets, leaves).alias("leaf"))
    return _whole(rows.groupBy("leaf").agg(*profile_aggregates(df, [], [])))


def _whole(digests: DataFrame) -> DataFrame:
    return digests.select("leaf", "n", *[F.col(c).cast("decimal(38,0)").alias(c) for c in COMPARED if c != "n"])


def added_up(*signed: tuple[DataFrame, int]) -> DataFrame:
    """The tree of all rows of the trees with sign 1 without those of the trees with sign -1; emptied leaves go."""
    parts = [t.select("leaf", *[(F.col(c) * sign).alias(c) for c in COMPARED]) for t, sign in signed]
    total = reduce(DataFrame.unionByName, parts).groupBy("leaf").agg(*[F.sum(c).alias(c) for c in COMPARED])
    return _whole(total.filter(" or ".join(f"{c} <> 0" for c in COMPARED)))


def load_delta(
    table: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS, leaves: int = LEAVES
) -> DataFrame:
    """What a load changes in the table's tree: its rows added, the rows that it replaces taken away.

    table: the rows before the load, or at least those of the leaves that the batch touches. batch: one row per key.
    Counts and lanes of a leaf may be negative.
    """
    named = batch.select(*[F.col(k).alias(f"_new_{i}") for i, k in enumerate(keys)])
    replaced = table.join(named, [F.col(k).eqNullSafe(F.col(f"_new_{i}")) for i, k in enumerate(keys)], "left_semi")
    return added_up((tree(batch, keys, columns, buckets, leaves), 1), (tree(replaced, keys, columns, buckets, leaves), -1))


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows ``(leaf, left_count, right_count)`` of leaves whose count or checksum differs, or that one side lacks."""
    joined = left.alias("s").join(right.alias("t"), F.col("s.leaf") == F.col("t.leaf"), "full_outer")
    return joined.filter(bands_differ()).select(
        F.coalesce("s.leaf", "t.leaf").alias("leaf"),
        F.coalesce("s.n", F.lit(0)).alias("left_count"),
        F.coalesce("t.n", F.lit(0)).alias("right_count"),
    )


class StoredVersion:
    """One version of a table as files: rows clustered by leaf below a folder per bucket, and its tree."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def store(
        cls, df: DataFrame, path: str, keys: list[str], columns: list[str], buckets: int = BUCKETS, leaves: int = LEAVES
    ) -> "StoredVersion":
        """Write rows and tree. The tree is that of the files, read back."""
        version = cls(df.sparkSession, path)
        placed = df.withColumn(LEAF, key_leaf(df, keys, buckets, leaves)).withColumn(BUCKET, F.expr(f"{LEAF} div {leaves}").cast("int"))
        # Rebalancing keeps a bucket's rows together and cuts a large bucket into several files.
        (placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, LEAF)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{version.path}/rows"))
        layout = {"keys": keys, "columns": columns, "buckets": buckets, "leaves": leaves}
        version.keep(tree(version.rows(), keys, columns, buckets, leaves))
        write_text(version.spark, f"{version.path}/layout.json", json.dumps(layout))
        return version

    @property
    def layout(self) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/layout.json"))

    def keep(self, digests: DataFrame) -> None:
        """Store a tree as this version's."""
        digests.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tree")

    def tree(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/tree")

    def rows(self, only: list[int] | None = None, leaves: int = LEAVES) -> DataFrame:
        """All rows, or those of some leaves: their buckets' folders, and of these the row groups that hold them."""
        stored = self.spark.read.parquet(f"{self.path}/rows")
        if only is not None:
            stored = stored.filter(F.col(BUCKET).isin(sorted({k // leaves for k in only})) & F.col(LEAF).isin(only))
        return stored.drop(LEAF, BUCKET)


def stored_delta(left: StoredVersion, right: StoredVersion) -> tuple[DataFrame, DataFrame]:
    """The delta of two stored versions: a report of one row, and the rows that differ.

    The trees say which leaves differ; their numbers, at most one per leaf, are collected, and the rows of other leaves are not
    read. Report: rows of both sides, leaves that hold rows, leaves that differ, keys missing on either side, keys with other counts
    or values, and the status.
    """
    layout = left.layout
    if layout != right.layout:
        raise ValueError(f"versions are laid out differently: {layout}, {right.layout}")
    differing = differing_leaves(left.tree(), right.tree())
    only = sorted(r["leaf"] for r in differing.select("leaf").collect())
    sides = [v.rows(only, layout["leaves"]) for v in (left, right)]
    rows = differing_rows(*sides, layout["keys"], layout["columns"])
    sizes = left.tree().select(F.col("leaf"), F.col("n").alias("l"), F.lit(0).cast("long").alias("r")).unionByName(
        right.tree().select(F.col("leaf"), F.lit(0).cast("long").alias("l"), F.col("n").alias("r"))).groupBy("leaf").agg(
        F.sum("l").alias("l"), F.sum("r").alias("r"))
    totals = sizes.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"), F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
                       F.count(F.lit(1)).alias("leaves"))
    reasons = rows.agg(
        F.count_if(F.col("reason") == "missing_in_target").alias("missing_right"),
        F.count_if(F.col("reason") == "missing_in_source").alias("missing_left"),
        F.count_if(~F.col("reason").isin("missing_in_target", "missing_in_source")).alias("changed"))
    # Both sides have one row.
    report = totals.withColumn("_one", F.lit(1)).join(reasons.withColumn("_one", F.lit(1)), "_one").select(
        "left_rows", "right_rows", "leaves", F.lit(len(only)).cast("long").alias("differing_leaves"),
        "missing_right", "missing_left", "changed",
        F.when(F.lit(not only), "PASSED").otherwise("FAILED").alias("status"))
    return report, rows
