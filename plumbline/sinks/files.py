"""Batch folders, sidecars and physical layouts as Parquet and JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.contracts import Contract
from plumbline.functions.digest import BUCKETS
from plumbline.operators.profile import hashed_rows, profile_aggregates
from plumbline.operators.transform import coercion_flags, normalise
from plumbline.session import delete_folder, write_text


@dataclass(frozen=True)
class Written:
    path: str
    rows: int
    watermark: str | None = None
    totals: dict = field(default_factory=dict, compare=False)
    """What ``reconcile.measured`` would give for the rows in target form, taken while they were written."""
    lost: dict[str, tuple[int, int]] = field(default_factory=dict, compare=False)
    """Column -> values that were there, and of them those that cannot be read as declared."""


def write_batch(df: DataFrame, path: str, watermark_column: str | None = None) -> Written:
    """Overwrite one batch folder. Rows and the highest watermark are counted while writing."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if watermark_column:
        metrics.append(F.max(watermark_column).cast("string").alias("watermark"))
    df.observe(seen, *metrics).write.mode("overwrite").parquet(path)
    values = seen.get
    return Written(path, values["rows"], values.get("watermark"))


def write_rows(spark: SparkSession, rows: list[dict], path: str) -> None:
    """A few rows as JSON lines in a folder of one file; writing again replaces them. No job is needed for so little."""
    write_text(spark, f"{path}/part-0.json", "".join(json.dumps(r, default=str, ensure_ascii=False) + "\n" for r in rows))


def write_schema(df: DataFrame, path: str) -> None:
    """Schema sidecar: one line of schema JSON."""
    write_text(df.sparkSession, f"{path}/part-0.txt", df.schema.json() + "\n")


def manifest(contract: Contract, written: Written, at: datetime) -> dict:
    return {
        "contract_fqn": contract.fqn, "operational_target": contract.operational, "analytical_target": contract.analytical,
        "row_count": written.rows, "output_path": written.path, "extracted_at": at.isoformat(), "load_strategy": contract.strategy,
        "partition_column": contract.partition_column, "partition_num_chunks": contract.partitions,
    }


def write_extract(df: DataFrame, contract: Contract, path: str, at: datetime) -> Written:
    """Batch folder with its schema and manifest beside it.

    While the rows are written they are also measured in target form, as the reconciliation needs it: counts, NULLs, sums and
    checksums, and per column the values that cannot be read as declared. So a source is read once.
    """
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if contract.strategy == "incremental_merge":
        metrics.append(F.max(f"_raw.`{contract.incremental_source}`").cast("string").alias("watermark"))
    flags = coercion_flags(df, contract)
    typed = normalise(df.withColumns({f"_present_{c}": f for c, (f, _) in flags.items()} | {f"_lost_{c}": f for c, (_, f) in flags.items()})
                      .withColumn("_raw", F.struct(*[f"`{c}`" for c in df.columns])), contract)
    aggregates = profile_aggregates(typed, contract.columns, contract.numeric_columns)
    rows = hashed_rows(typed, contract.columns, contract.numeric_columns, "_raw", *[f"_{k}_{c}" for c in flags for k in ("present", "lost")])
    metrics += [F.count_if(f"_{k}_{c}").alias(f"_{k}_{c}") for c in flags for k in ("present", "lost")]
    rows.observe(seen, *metrics, *aggregates).select("_raw.*").write.mode("overwrite").parquet(f"{path}/data")
    values = seen.get
    lost = {c: (values[f"_present_{c}"], values[f"_lost_{c}"]) for c in flags}
    written = Written(f"{path}/data", values["rows"], values.get("watermark"), values, lost)
    write_schema(df, f"{path}/_schema")
    write_rows(df.sparkSession, [manifest(contract, written, at)], f"{path}/_manifest")
    return written


def write_hourly(df: DataFrame, ts: str, path: str) -> None:
    """Change feed partitioned by day and hour.

    Rebalancing by hour lets Spark split an hour that holds most rows into several files.
    """
    parts = df.withColumns({"dt": F.date_format(ts, "yyyy-MM-dd"), "hh": F.date_format(ts, "HH")})
    parts.hint("rebalance", "dt", "hh").write.mode("overwrite").partitionBy("dt", "hh").parquet(path)


def layout_keys(contract: Contract) -> tuple[str | None, list[str]]:
    """Distribution key and sort keys the contract implies."""
    distribution = None if contract.replicated or not contract.keys else contract.keys[0]
    sort = [*contract.keys[:1], *([contract.incremental] if contract.incremental else []), "_loaded_at"]
    return distribution, list(dict.fromkeys(sort))


def write_keyed(df: DataFrame, contract: Contract, path: str, partitions: int | None = None) -> None:
    """Rows of near keys in the same file, sorted, so that key and date filters skip row groups.

    Key ranges come from a sample of the data, which keeps files even.
    """
    distribution, sort = layout_keys(contract)
    sort = [c for c in sort if c in df.columns]
    if distribution is None:
        df.sortWithinPartitions(*sort).write.mode("overwrite").parquet(path)
        return
    n = [partitions] if partitions else []
    df.repartitionByRange(*n, *sort).sortWithinPartitions(*sort).write.mode("overwrite").parquet(path)


def save_bucketed(df: DataFrame, contract: Contract, table: str, buckets: int = BUCKETS) -> None:
    """Catalogue table bucketed by the keys: joins and key checks on it need no shuffle."""
    keys = list(contract.keys)
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def purge_partitions(spark: SparkSession, path: str, partition: str, keep: Column) -> list:
    """Delete the rows for which ``keep`` is not true, by rewriting only the partitions that hold any. Gives these partitions' values.

    Partitions of which nothing is left are removed; files of others keep their names. What is collected is one row per partition
    touched. A run that was cut short can be run again: it finds what is left to purge.
    """
    stored = spark.read.parquet(path)
    gone = ~F.coalesce(keep, F.lit(False))
    touched = stored.groupBy(partition).agg(F.count_if(gone).alias("gone"), F.count_if(~gone).alias("left")).filter("gone > 0").collect()
    rewritten = [r[partition] for r in touched if r["left"]]
    if rewritten:
        rows = stored.filter(F.col(partition).isin(rewritten) & ~gone)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for r in touched:
        if not r["left"]:
            delete_folder(spark, f"{path}/{partition}={r[partition]}")
    return sorted(r[partition] for r in touched)
