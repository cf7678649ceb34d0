"""Change files → bronze log → silver state, each step exactly once by checkpoint."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.contracts import Contract
from plumbline.operators.merge import DELETED, OP_COLUMN, latest_per_key, tombstone
from plumbline.operators.transform import mask_personal, normalise
from plumbline.session import read_text
from plumbline.sinks.versioned import VersionedTable

COMMITTED = "_dms_committed_at"
SEQUENCE = "_seq"
ORDER = [COMMITTED, SEQUENCE]


def feed_schema(contract: Contract, stored: dict[str, T.DataType] | None = None) -> T.StructType:
    """Declared schema of change files. Columns a file lacks arrive as NULL.

    A contract that gains a column widens this schema; restarting the stream picks it up.
    """
    stored = stored or {}
    fields = [
        T.StructField(OP_COLUMN, T.StringType()),
        T.StructField(COMMITTED, T.TimestampType()),
        T.StructField(SEQUENCE, T.LongType()),
    ]
    fields += [T.StructField(f.source, stored.get(f.source, T.StringType())) for f in contract.data_fields]
    return T.StructType(fields)


def bronze_schema(feed: T.StructType) -> T.StructType:
    return T.StructType([
        *feed.fields,
        T.StructField("_cdc_ingested_at", T.TimestampType()),
        T.StructField("_cdc_source_file", T.StringType()),
    ])


def silver_schema(contract: Contract) -> T.StructType:
    """The same fields from the first commit on: values, order columns, delete mark."""
    return T.StructType([
        *contract.target_schema().fields,
        T.StructField(COMMITTED, T.TimestampType()),
        T.StructField(SEQUENCE, T.LongType()),
        T.StructField(DELETED, T.BooleanType()),
    ])


def ingest_bronze(
    spark: SparkSession, feed_dir: str, bronze_dir: str, checkpoint: str, schema: T.StructType,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every new change file to bronze, with ingest time and file; stops when caught up."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    enriched = reader.parquet(feed_dir).withColumns({
        "_cdc_ingested_at": F.current_timestamp(),
        "_cdc_source_file": F.col("_metadata.file_path"),
    })
    return (
        enriched.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/bronze")
        .trigger(availableNow=True)
        .start(bronze_dir)
    )


def last_commit(query: StreamingQuery) -> int | None:
    """Number of the last micro-batch that a running stream has committed with rows; None before the first."""
    return max((p.batchId for p in query.recentProgress if p.numInputRows), default=None)


def versions_of(events: DataFrame, contract: Contract) -> DataFrame:
    """Bronze events in silver form."""
    keep = events.withColumn(DELETED, tombstone())
    audit = [COMMITTED, SEQUENCE, DELETED]
    return normalise(keep, contract).select(*contract.columns, *audit)


def _each_batch(
    spark: SparkSession, bronze_dir: str, checkpoint: str, schema: T.StructType,
    write: Callable[[DataFrame, int], None], max_files: int | None,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(bronze_dir).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A micro-batch by its number and its stream. A new checkpoint is another stream, and counts from 0 again."""
    stream = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
    return f"{stream}-{batch_id}"


def merge_silver(
    spark: SparkSession, bronze_dir: str, silver: VersionedTable, checkpoint: str, contract: Contract,
    schema: T.StructType, max_files: int | None = None, changes_dir: str | None = None,
) -> StreamingQuery:
    """Merge new bronze events into silver. A replayed micro-batch is recognised and skipped.

    changes_dir: where the row-level changes of silver are appended for readers of their own pace (``follow_changes``). They are written
    before the commit, so none is missing; after a failure some come twice, which a merge by their order does not notice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # One file is mostly one task's to read, so its rows are dealt out; by their order, lest all rows of a busy key go to one task.
        versions = latest_per_key(versions_of(batch.repartition(*ORDER), contract), list(contract.keys), ORDER).persist()
        try:
            if changes_dir is not None:
                versions.write.mode("append").parquet(changes_dir)
            silver.apply(versions, ORDER, batch_name(spark, f"{checkpoint}/silver", batch_id), staged=True)
        finally:
            versions.unpersist()

    return _each_batch(spark, bronze_dir, f"{checkpoint}/silver", schema, write, max_files)


def feed_targets(
    spark: SparkSession, bronze_dir: str, operational: VersionedTable, analytical: VersionedTable,
    checkpoint: str, contract: Contract, schema: T.StructType, max_files: int | None = None,
) -> StreamingQuery:
    """Merge new events into both targets; the analytical one receives hashed personal columns.

    Each target remembers the micro-batches it has taken, so a failure between the two writes
    repeats only the missing one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        versions, name = versions_of(batch, contract), batch_name(spark, f"{checkpoint}/targets", batch_id)
        operational.apply(versions, ORDER, name, staged=True)
        analytical.apply(mask_personal(versions, contract), ORDER, name, staged=True)

    return _each_batch(spark, bronze_dir, f"{checkpoint}/targets", schema, write, max_files)


def follow_changes(
    spark: SparkSession, changes_dir: str, target: VersionedTable, checkpoint: str, contract: Contract, masked: bool = False,
    every: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """Keep one target up with silver's row-level changes, at its own pace and by its own checkpoint.

    every: the time between merges, say "5 minutes"; without it, what is there is merged and the stream ends. A target that lags takes more
    changes at once and ends up the same.
    """
    reader = spark.readStream.schema(silver_schema(contract))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = mask_personal(batch, contract) if masked else batch
        target.apply(rows, ORDER, batch_name(spark, checkpoint, batch_id), staged=True)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return reader.parquet(changes_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
