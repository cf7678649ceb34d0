"""At most one trigger per table and period, on a stream of object arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.monitor import DEBOUNCE, table_of_path


def debounced_stream(
    arrivals: DataFrame, ts: str = "ts", path: str = "path", period: str = DEBOUNCE, lateness: str = "10 minutes"
) -> DataFrame:
    """One row per table and tumbling period, emitted when its first arrival is seen.

    The watermark bounds the state: periods older than it are forgotten.
    """
    return (
        arrivals.withColumn("table_name", table_of_path(F.col(path)))
        .filter("table_name is not null")
        .withColumn("period_start", F.window(ts, period)["start"])
        .withWatermark(ts, lateness)
        .dropDuplicatesWithinWatermark(["table_name", "period_start"])
        .select("table_name", "period_start", F.col(ts).alias("triggered_at"))
    )


def first_arrivals_stream(
    arrivals: DataFrame, ts: str = "ts", path: str = "path", period: str = DEBOUNCE, lateness: str = "10 minutes"
) -> DataFrame:
    """One row per table and tumbling period with its first arrival, emitted once no earlier one can come (append mode).

    Arrivals may come out of order by up to ``lateness``: the first of a period is the earliest by its own time, whichever trigger it
    came in. Later ones, of periods that the watermark had passed a trigger before, are dropped. All arrivals move the watermark,
    also those of no table. The state holds one time per table and open period.
    """
    seen = arrivals.withWatermark(ts, lateness).withColumn("table_name", table_of_path(F.col(path)))
    # A condition on the path alone would be moved below the watermark, which then stood still while no table has arrivals.
    named = seen.filter(F.col("table_name").isNotNull() | F.col(ts).isNull())
    return named.groupBy("table_name", F.window(ts, period)).agg(F.min(ts).alias("triggered_at")).select(
        "table_name", F.col("window.start").alias("period_start"), "triggered_at")
