"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import scratch_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files that no plan in use refers to go.

    Spark's cleaner removes them once the driver has collected its garbage, which a driver with little to do may put off until the disks are full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker and is shared by its tasks."""
    module = sys.modules.get("_plumbline_worker_cache")
    if module is None:
        module = types.ModuleType("_plumbline_worker_cache")
        module.entries = {}
        sys.modules["_plumbline_worker_cache"] = module
    return module.entries
