"""Questions about the run ledger.

The ledger is an append-only table of entries ``(kind, job, name, status, at, row_count,
error_message, watermark)``: kind ``batch`` with a batch id as name, or kind ``watermark`` with a
table as name. The newest entry of a (kind, job, name) is the state of that item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.merge import latest_per_key

STARTED, SUCCEEDED, FAILED, ROLLED_BACK = "STARTED", "SUCCEEDED", "FAILED", "ROLLED_BACK"
BATCH, WATERMARK = "batch", "watermark"
ERROR_LENGTH = 1000
EXPIRY_DAYS = 30
STUCK_HOURS = 24

SCHEMA = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("job", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("status", T.StringType()),
    T.StructField("at", T.TimestampType(), False),
    T.StructField("row_count", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("watermark", T.StringType()),
])


def batches(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("kind") == BATCH)


def latest_status(entries: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Newest entry per (job, batch)."""
    return latest_per_key(batches(entries), ["job", "name"], ["at", *(tie or [])])


def batch_items(entries: DataFrame, tie: Column | None = None) -> DataFrame:
    """One item per (job, batch): state, start of the latest attempt, completion, rows and error.

    A plain aggregate, so repeated attempts of one batch combine before the shuffle.
    """
    when = F.struct("at", tie) if tie is not None else F.col("at")
    started = F.col("status") == STARTED
    return batches(entries).groupBy("job", "name").agg(
        F.max_by("status", when).alias("status"),
        F.max(F.when(started, F.col("at"))).alias("started_at"),
        F.max(F.when(~started, F.col("at"))).alias("completed_at"),
        F.max_by("row_count", when).alias("row_count"),
        F.substring(F.max_by("error_message", when), 1, ERROR_LENGTH).alias("error_message"),
    )


def to_process(work: DataFrame, entries: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Work ``(job, name)`` that has not succeeded."""
    done = latest_status(entries, tie).filter(F.col("status") == SUCCEEDED).select("job", "name")
    return work.join(done, ["job", "name"], "left_anti")


def startable(work: DataFrame, entries: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Work that has never started, or whose last attempt failed or was rolled back."""
    taken = latest_status(entries, tie).filter(~F.col("status").isin(FAILED, ROLLED_BACK)).select("job", "name")
    return work.join(taken, ["job", "name"], "left_anti")


def watermarks(entries: DataFrame, tie: Column | None = None) -> DataFrame:
    """Current watermark per (job, table)."""
    when = F.struct("at", tie) if tie is not None else F.col("at")
    return entries.filter(F.col("kind") == WATERMARK).groupBy("job", "name").agg(
        F.max_by("watermark", when).alias("watermark"), F.max("at").alias("updated_at")
    )


def unexpired(entries: DataFrame, now, days: int = EXPIRY_DAYS) -> DataFrame:
    """Batch entries of the last ``days``, and every watermark."""
    cutoff = F.lit(now) - F.expr(f"INTERVAL {days} DAYS")
    return entries.filter((F.col("kind") == WATERMARK) | (F.col("at") >= cutoff))


def stuck(entries: DataFrame, now, hours: int = STUCK_HOURS, tie: list[str] | None = None) -> DataFrame:
    """Batches whose latest entry says started, more than ``hours`` ago."""
    cutoff = F.lit(now) - F.expr(f"INTERVAL {hours} HOURS")
    return latest_status(entries, tie).filter((F.col("status") == STARTED) & (F.col("at") < cutoff))


def with_prefix(entries: DataFrame, prefix: str) -> DataFrame:
    """Entries whose job and name begin with a text, for an audit."""
    return entries.filter(F.concat_ws("#", "kind", "job", "name").startswith(prefix))


def unconsumed(queue: DataFrame, consumed: DataFrame, request: str) -> DataFrame:
    """Queue rows of requests that were not consumed yet."""
    return queue.join(consumed.select(request).distinct(), request, "left_anti")
