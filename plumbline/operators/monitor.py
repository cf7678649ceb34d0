"""Alarms, streaks and roll-ups over run histories.

Every window function here runs over rows already reduced to one per key and period, so a key's
window is as long as the calendar, not as long as its history of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GREEN_NIGHTS = 7
STABLE_DAYS = 30
DIFF_DAYS = 14
DIFF_LIMIT_PCT = 0.01
LAG_LIMIT_SECONDS = 60.0
LAG_PERIODS = 3
DRIFT_LIMIT_PCT = 1.0
DEBOUNCE = "5 minutes"


def _epoch(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def green_streaks(nights: DataFrame, table: str, day: str, green: str) -> DataFrame:
    """Runs of consecutive green days: rows ``(table_name, first_day, last_day, nights)``.

    Expects one row per table and day.
    """
    by_day = Window.partitionBy(table).orderBy(day)
    island = F.date_sub(F.col(day), F.row_number().over(by_day))
    return nights.filter(F.col(green)).withColumn("_island", island).groupBy(
        F.col(table).alias("table_name"), "_island"
    ).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("nights")
    ).drop("_island")


def streak_gate(nights: DataFrame, table: str, day: str, green: str, needed: int = GREEN_NIGHTS) -> DataFrame:
    """Per table: length of the streak that reaches the last day, and whether it opens the gate."""
    last = nights.groupBy(F.col(table).alias("table_name")).agg(F.max(day).alias("last_day"))
    streaks = green_streaks(nights, table, day, green).select("table_name", "last_day", "nights")
    joined = last.join(streaks, ["table_name", "last_day"], "left")
    nights_green = F.coalesce("nights", F.lit(0)).cast("bigint")
    return joined.select(
        "table_name", "last_day",
        nights_green.alias("green_nights"),
        (nights_green >= needed).alias("gate_open"),
    )


def diff_rate_gate(
    rates: DataFrame, table: str, day: str, requests: str, mismatches: str,
    days: int = DIFF_DAYS, limit_pct: float = DIFF_LIMIT_PCT,
) -> DataFrame:
    """Per table: were all of the last ``days`` days present and below the limit?"""
    last = rates.groupBy(table).agg(F.max(day).alias("_last"))
    recent = rates.join(last, table).filter(F.col(day) > F.date_sub(F.col("_last"), days))
    pct = F.col(mismatches).cast("double") / F.col(requests).cast("double") * 100.0
    return recent.groupBy(F.col(table).alias("table_name")).agg(
        F.count(F.lit(1)).alias("days_seen"),
        F.count_if(pct < limit_pct).alias("days_below"),
    ).withColumn("gate_open", (F.col("days_seen") >= days) & (F.col("days_seen") == F.col("days_below")))


def periods(df: DataFrame, ts: str, keys: list[str], period: str, measure: Column) -> DataFrame:
    """One row per key and period: ``(<keys>, period_start, measure)``."""
    return df.groupBy(*keys, F.window(ts, period).alias("_w")).agg(measure.alias("measure")).select(
        *keys, F.col("_w.start").alias("period_start"), "measure"
    )


def consecutive_breaches(
    df: DataFrame, ts: str, keys: list[str], value: str, *,
    limit: float = LAG_LIMIT_SECONDS, count: int = LAG_PERIODS, seconds: int = 60,
) -> DataFrame:
    """Periods that end ``count`` breaching periods in a row. A missing period is no breach.

    A breach is an average above the limit. Rows ``(<keys>, period_start, measure)``.
    """
    averaged = periods(df, ts, keys, f"{seconds} seconds", F.avg(value))
    frame = Window.partitionBy(*keys).orderBy(_epoch(F.col("period_start"))).rangeBetween(-(count - 1) * seconds, 0)
    breaching = F.sum(F.when(F.col("measure") > limit, 1).otherwise(0)).over(frame)
    return averaged.withColumn("_run", breaching).filter(F.col("_run") == count).drop("_run")


def threshold_alarm(
    df: DataFrame, ts: str, keys: list[str], measure: Column, limit, period: str = "300 seconds"
) -> DataFrame:
    """Periods whose measure exceeds the limit."""
    return periods(df, ts, keys, period, measure).filter(F.col("measure") > limit)


def drift_alarm(df: DataFrame, ts: str, keys: list[str], drift_pct: str, limit: float = DRIFT_LIMIT_PCT) -> DataFrame:
    return threshold_alarm(df, ts, keys, F.max(drift_pct), limit)


def failure_alarm(df: DataFrame, ts: str, keys: list[str], failed: Column) -> DataFrame:
    return threshold_alarm(df, ts, keys, F.count_if(failed), 0)


def rows_per_hour(df: DataFrame, ts: str, keys: list[str], rows: Column) -> DataFrame:
    return periods(df, ts, keys, "1 hour", F.sum(rows)).withColumnsRenamed(
        {"period_start": "hour", "measure": "row_count"}
    )


def throughput_trend(runs: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Seconds per row, by job and day: mean and median.

    Expects ``(job, started_at, completed_at, row_count)``.
    """
    micros = F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(
        F.col("started_at").cast("timestamp")
    )
    per_row = micros.cast("double") / 1e6 / F.col("row_count").cast("double")
    return runs.filter(F.col("row_count") > 0).groupBy("job", F.to_date("completed_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.round(F.avg(per_row), 4).alias("avg_seconds_per_row"),
        F.round(F.percentile_approx(per_row, 0.5, accuracy), 4).alias("median_seconds_per_row"),
    )


def table_of_path(path: Column, area: str = "cdc", system: str = "sap") -> Column:
    """Table name in ``cdc/sap/<TABLE>/…``; NULL for any other path."""
    parts = F.split(path, "/")
    fits = (F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == area) & (F.get(parts, F.lit(1)) == system)
    return F.when(fits, F.get(parts, F.lit(2)))


def debounced(arrivals: DataFrame, ts: str, path: str, period: str = DEBOUNCE) -> DataFrame:
    """First arrival per table and period: rows ``(table_name, period_start, triggered_at)``."""
    named = arrivals.withColumn("table_name", table_of_path(F.col(path))).filter("table_name is not null")
    return periods(named, ts, ["table_name"], period, F.min(ts)).withColumnRenamed("measure", "triggered_at")


def latest_run(runs: DataFrame, chain: str, order: list[str]) -> DataFrame:
    """Newest run of one chain, by descending date then time; empty if it never ran."""
    return runs.filter(F.col("chain_id") == chain).orderBy(*[F.desc(c) for c in order]).limit(1)


def require_green(runs: DataFrame, chain: str, order: list[str], status: str = "status") -> None:
    """Refuse to go on unless the newest run of the chain ended green."""
    row = latest_run(runs, chain, order).first()
    if row is None:
        raise RuntimeError(f"chain {chain} has never run")
    if row[status] != "G":
        raise RuntimeError(f"chain {chain} last ended with {row[status]!r}, not 'G'")
