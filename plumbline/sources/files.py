"""Parquet and CSV inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import Contract
from plumbline.operators.transform import CLIENT_COLUMN

NULL_MARK = "\\N"
# Padding is part of the values.
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def batch(spark: SparkSession, path: str) -> DataFrame:
    """One extracted batch folder."""
    return spark.read.parquet(path)


def csv_extract(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Sample extract: every column is text, ids zero-padded, dates yyyyMMdd. Nothing is inferred."""
    columns = [T.StructField(CLIENT_COLUMN, T.StringType()), *contract.source_text_schema().fields]
    text = spark.read.schema(T.StructType(columns)).options(**CSV_OPTIONS).csv(path)
    # An empty field is a blank flag, not a missing value; NULL has a mark of its own.
    return text.select(*[
        F.when(F.col(c) == NULL_MARK, F.lit(None)).otherwise(F.coalesce(c, F.lit(""))).alias(c) for c in text.columns
    ])


def write_csv_extract(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS, nullValue=NULL_MARK).csv(path)
