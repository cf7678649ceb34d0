"""Audit of masked columns: do they hold hashes, or something that looks like personal data?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.rules import EMAIL_PATTERN

# Shape of a SHA-256 hash, of a phone number, and the share that counts as masked.
HASH_PATTERN = r"^[0-9a-f]{64}$"
PHONE_PATTERN = r"^[\+\d\-\(\)\s]{7,}$"
MASKED_SHARE = 0.95

MASKED, RAW_FOUND, NO_DATA = "MASKED", "FAIL_RAW_PII_FOUND", "NO_DATA"


def bounded_values(df: DataFrame, column: str, rows: int = 1000) -> DataFrame:
    """Some non-null values of a column, for a quick look."""
    return df.select(column).filter(F.col(column).isNotNull()).orderBy(column).limit(rows)


def audit_columns(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows ``(column_name, checked, hashed_count, raw_email_like, raw_phone_like, status)``.

    Every value is checked; all columns share one aggregate.
    """
    aggregates, structs = [], []
    for i, name in enumerate(columns):
        col = F.col(name)
        aggregates += [
            F.count(col).alias(f"n{i}"),
            F.count_if(col.rlike(HASH_PATTERN)).alias(f"h{i}"),
            F.count_if(col.rlike(EMAIL_PATTERN)).alias(f"e{i}"),
            F.count_if(col.rlike(PHONE_PATTERN)).alias(f"p{i}"),
        ]
        n, hashed = F.col(f"n{i}"), F.col(f"h{i}")
        status = (
            F.when(n == 0, NO_DATA)
            .when(hashed.cast("double") > n.cast("double") * MASKED_SHARE, MASKED)
            .otherwise(RAW_FOUND)
        )
        structs.append(F.struct(
            F.lit(f"{table}.{name}").alias("column_name"),
            n.alias("checked"),
            hashed.alias("hashed_count"),
            F.col(f"e{i}").alias("raw_email_like"),
            F.col(f"p{i}").alias("raw_phone_like"),
            status.alias("status"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def audit_status(rows: DataFrame) -> DataFrame:
    """One row ``(overall_status, columns_checked, failed_columns)``."""
    failed = F.col("status") == RAW_FOUND
    return rows.agg(
        F.when(F.count_if(failed) > 0, "FAIL").otherwise("PASS").alias("overall_status"),
        F.count(F.lit(1)).alias("columns_checked"),
        F.count_if(failed).alias("failed_columns"),
    )
