"""Reconciliation of one increment: a half-open window, key uniqueness in it, and a spot check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import Contract
from plumbline.functions.digest import BUCKETS, row_text
from plumbline.operators.checksum import differing_rows
from plumbline.operators.reconcile import FAILED, PASSED, key_uniqueness, severity, status_of

WINDOW_TOLERANCE_PCT = 0.1
SPOT_CHECK_ROWS = 50


def in_window(df: DataFrame, column: str, after, up_to) -> DataFrame:
    """Rows with ``after < column <= up_to``; the bounds reach the scan as pushed filters."""
    return df.filter((F.col(column) > F.lit(after)) & (F.col(column) <= F.lit(up_to)))


def newer_than(df: DataFrame, column: str, watermark, whole_days: bool | None = None) -> DataFrame:
    """Incremental read; without a watermark it is a full read.

    A column of whole days is read from the watermark's day on, since more rows of that day may have come; merging
    a row again changes nothing but its batch. By default dates and text (raw dates) are whole days.
    """
    if watermark is None:
        return df
    if whole_days is None:
        whole_days = isinstance(df.schema[column].dataType, (T.DateType, T.StringType))
    return df.filter(F.col(column) >= F.lit(watermark) if whole_days else F.col(column) > F.lit(watermark))


def window_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row ``(source_count, target_count, diff_pct, status)``; the limit is strict."""
    counted = source.agg(F.count(F.lit(1)).alias("s"), F.lit(0).cast("bigint").alias("t")).unionByName(
        target.agg(F.lit(0).cast("bigint").alias("s"), F.count(F.lit(1)).alias("t"))
    ).agg(F.sum("s").alias("source_count"), F.sum("t").alias("target_count"))
    diff = F.when(
        F.col("source_count") > 0,
        F.abs(F.col("source_count") - F.col("target_count")).cast("double")
        / F.col("source_count").cast("double") * 100.0,
    ).otherwise(0.0)
    return counted.select(
        "source_count",
        "target_count",
        F.round(diff, 4).alias("diff_pct"),
        F.when(diff < WINDOW_TOLERANCE_PCT, PASSED).otherwise(FAILED).alias("status"),
    )


def window_key_uniqueness(target: DataFrame, keys: list[str]) -> DataFrame:
    return key_uniqueness(target, keys).select(
        F.col("total_rows"),
        F.col("duplicate_count"),
        F.when(F.col("duplicate_count") == 0, PASSED).otherwise(FAILED).alias("status"),
    )


def sampled_keys(df: DataFrame, keys: list[str], seed: int = 0, rows: int = SPOT_CHECK_ROWS) -> DataFrame:
    """A repeatable random sample of keys: the smallest hashes under a seed.

    The limit is the sample size, and each task keeps only its own smallest rows.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), row_text(df, keys)))
    return df.select(*keys, order.alias("_order")).orderBy("_order", *keys).limit(rows).select(*keys)


def spot_check(source: DataFrame, target: DataFrame, keys: list[str], seed: int = 0, rows: int = SPOT_CHECK_ROWS) -> DataFrame:
    """Sampled target keys, each with whether the source has it.

    The sample has at most ``rows`` rows, so broadcasting it is bounded; the source is
    reduced to the sampled keys by a semi join before anything is shuffled.
    """
    sample = sampled_keys(target, keys, seed, rows).distinct()
    present = source.select(*keys).join(F.broadcast(sample), keys, "left_semi").distinct()
    return sample.join(present.withColumn("_found", F.lit(True)), keys, "left").select(
        *keys, F.coalesce("_found", F.lit(False)).alias("found_in_source")
    )


def spot_check_status(checked: DataFrame) -> DataFrame:
    """An empty window has nothing to check and passes."""
    return checked.agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.count_if("found_in_source").alias("found_count"),
    ).withColumn("status", F.when(F.col("sample_size") == F.col("found_count"), PASSED).otherwise(FAILED))


def stale_rows(
    source: DataFrame, target: DataFrame, contract: Contract, watermark, buckets: int = BUCKETS
) -> DataFrame:
    """Rows at or before the watermark that no longer match."""
    old = F.col(contract.incremental) <= F.lit(watermark)
    return differing_rows(
        source.filter(old), target.filter(old), list(contract.keys), contract.columns, buckets
    )


def window_report(
    source: DataFrame, target: DataFrame, contract: Contract, after, up_to, seed: int = 0
) -> DataFrame:
    """The three window layers as rows ``(layer, status, evidence)``."""
    keys = list(contract.keys)
    s = in_window(source, contract.incremental, after, up_to)
    t = in_window(target, contract.incremental, after, up_to)
    parity = window_parity(s, t).select(
        F.lit("row_count_window").alias("layer"), "status",
        F.to_json(F.struct("source_count", "target_count")).alias("evidence"),
    )
    unique = window_key_uniqueness(t, keys).select(
        F.lit("pk_uniqueness_window").alias("layer"), "status",
        F.to_json(F.struct(F.col("duplicate_count").alias("duplicates"), F.col("total_rows").alias("total")))
        .alias("evidence"),
    )
    spot = spot_check_status(spot_check(s, t, keys, seed)).select(
        F.lit("pk_spot_check").alias("layer"), "status",
        F.to_json(F.struct("sample_size", "found_count")).alias("evidence"),
    )
    return parity.unionByName(unique).unionByName(spot)


def window_overall(report: DataFrame) -> DataFrame:
    """One row for a window report: the worst status of its layers, and how many layers failed or warned."""
    rank = severity(F.col("status"))
    return report.agg(
        status_of(F.max(rank)).alias("overall_status"), F.count(F.lit(1)).alias("layers"),
        F.count_if(rank == 2).alias("failed"), F.count_if(rank == 1).alias("warned"),
    )
