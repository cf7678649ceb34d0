"""One-pass table profiles.

``bucket_profile`` is the shared scan behind reconciliation: counts, NULL counts, sums and checksum
lanes, all of one table, grouped by key bucket. Map tasks shrink their input to at most one row per
bucket, so the shuffle is a few hundred rows whatever the table's size or skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.digest import BUCKETS, exact_lane, key_bucket, lane, lane_sum, quoted, row_text

SUM_TYPE = T.DecimalType(38, 6)


def summed(name: str, kind: T.DataType) -> str:
    """Sum as an exact decimal where the column is exact, so that engines and task orders agree."""
    col = quoted(name)
    if isinstance(kind, T.IntegralType):
        col = f"cast({col} as decimal(20,0))"
    elif not isinstance(kind, T.DecimalType):
        # Floats, and numbers still held as text; NaN and words add nothing.
        col = f"try_cast({col} as decimal(28,6))"
    return f"cast(sum({col}) as decimal(38,6))"


def unsummed(name: str, kind: T.DataType) -> str | None:
    """Sum, in floating point, of the values that ``summed`` leaves out as too large or no number."""
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return None
    col = quoted(name)
    value = f"try_cast({col} as double)"
    return f"sum(if(try_cast({col} as decimal(28,6)) is null, {value}, null))"


def bucket_profile(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    numeric: list[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows ``(bucket, n, lane0, lane1, lane2, null_<column>…, sum_<column>…, rest_<column>…)``.

    ``lane2`` and ``rest_`` are for comparisons inside Spark: the bits of floats, and the numbers that an exact
    sum cannot hold.
    """
    bucket = (key_bucket(df, keys, buckets) if keys else F.lit(0)).alias("bucket")
    return hashed_rows(df, columns, numeric, bucket).groupBy("bucket").agg(*profile_aggregates(df, columns, numeric))


def hashed_rows(df: DataFrame, columns: list[str], numeric: list[str], *more: Column) -> DataFrame:
    """What ``profile_aggregates`` works on: the columns, the lanes of their row, and anything else asked for."""
    return df.select(
        *dict.fromkeys([*columns, *numeric]),
        *more,
        F.md5(row_text(df, columns)).alias("_md5"),
        F.expr(exact_lane(df, columns)).alias("_lane2"),
    ).withColumns({f"_lane{i}": F.expr(lane("_md5", i)) for i in (0, 1)})


def profile_aggregates(df: DataFrame, columns: list[str], numeric: list[str]) -> list[Column]:
    """Aggregates ``n, lane0, lane1, lane2, null_<column>…, sum_<column>…, rest_<column>…`` with the types of df's columns."""
    aggregates = ["count(1) as n", *[f"{lane_sum(f'_lane{i}')} as lane{i}" for i in (0, 1, 2)]]
    aggregates += [f"count_if({quoted(c)} is null) as {quoted(f'null_{c}')}" for c in columns]
    aggregates += [f"{summed(c, df.schema[c].dataType)} as {quoted(f'sum_{c}')}" for c in numeric]
    rest = {c: unsummed(c, df.schema[c].dataType) or "cast(null as double)" for c in numeric}
    aggregates += [f"{text if 'sum(' in text else f'max({text})'} as {quoted(f'rest_{c}')}" for c, text in rest.items()]
    return [F.expr(a) for a in aggregates]


def table_profile(
    df: DataFrame, columns: list[str], accuracy: int = 10_000, quantiles: bool = True
) -> DataFrame:
    """Rows, NULLs and, for numbers, extremes, sum, mean, deviation, median and 95th percentile.

    A single aggregate over a single scan. Quantiles come from a sketch with a relative rank error
    of 1/accuracy; without them, the aggregate's state is a handful of numbers.
    """
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    structs = []
    none = F.lit(None)
    for i, name in enumerate(columns):
        kind = df.schema[name].dataType
        col = F.col(name)
        aggregates.append(F.count_if(col.isNull()).alias(f"nulls{i}"))
        is_number = isinstance(kind, T.NumericType)
        if is_number:
            aggregates += [
                F.min(col).cast("double").alias(f"min{i}"),
                F.max(col).cast("double").alias(f"max{i}"),
                F.expr(summed(name, kind)).alias(f"sum{i}"),
                F.stddev_samp(col.cast("double")).alias(f"dev{i}"),
            ]
            if quantiles:
                aggregates.append(F.percentile_approx(col.cast("double"), [0.5, 0.95], accuracy).alias(f"pct{i}"))
        filled = F.col("n_rows") - F.col(f"nulls{i}")
        structs.append(F.struct(
            F.lit(name).alias("column_name"),
            F.col("n_rows"),
            F.col(f"nulls{i}").alias("null_count"),
            (F.col(f"min{i}") if is_number else none.cast("double")).alias("min_value"),
            (F.col(f"max{i}") if is_number else none.cast("double")).alias("max_value"),
            (F.col(f"sum{i}") if is_number else none.cast(SUM_TYPE)).alias("sum_value"),
            (F.round(F.try_divide(F.col(f"sum{i}").cast("double"), filled), 4) if is_number else none.cast("double"))
            .alias("mean_value"),
            (F.round(F.col(f"dev{i}"), 4) if is_number else none.cast("double")).alias("stddev_value"),
            *[
                (F.col(f"pct{i}")[j] if is_number else none.cast("double")).alias(label)
                for j, label in enumerate(("median_value", "p95_value")) if quantiles
            ],
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))
