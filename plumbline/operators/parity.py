"""Comparisons across several targets, and across an old and a new system."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.contracts import Contract
from plumbline.functions.digest import BUCKETS
from plumbline.operators.reconcile import FAILED, PASSED, layer_rows, overall, severity, status_of
from plumbline.operators.transform import mask_personal


ROLLBACK_LIMIT_PCT = 0.1


def three_way(
    raw: DataFrame, operational: DataFrame, analytical: DataFrame, contract: Contract, buckets: int = BUCKETS
) -> DataFrame:
    """Layer rows of raw against each target and of the targets against each other.

    Where the right side is masked, the left is masked alike before comparing.
    Rows ``(comparison, layer, status, message, evidence)``.
    """
    pairs = {
        "raw_vs_operational": (raw, operational),
        "raw_vs_analytical": (mask_personal(raw, contract), analytical),
        "operational_vs_analytical": (mask_personal(operational, contract), analytical),
    }
    rows = None
    for name, (left, right) in pairs.items():
        part = layer_rows(left, right, contract, buckets).select(F.lit(name).alias("comparison"), "*")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def comparison_statuses(rows: DataFrame) -> DataFrame:
    """Worst status per comparison."""
    return rows.groupBy("comparison").agg(status_of(F.max(severity(F.col("status")))).alias("status"))


def three_way_overall(rows: DataFrame) -> DataFrame:
    """Fails only on a failed comparison; warnings do not count."""
    return overall(rows, warnings_count=False)


def shadow_differences(old: DataFrame, new: DataFrame, request: list[str], answer: list[str]) -> DataFrame:
    """Per request: whether the two systems gave different answers, or only one answered.

    Answers are stacked and reduced per request with map-side combining, so repeated requests, one
    of which may be very frequent, need no skewed outer join. Rows ``(<request>, mismatch)``.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            *request, *answer,
            F.lit(sign).cast("bigint").alias("_sign"),
        )

    per_answer = side(old, 1).unionByName(side(new, -1)).groupBy(*request, *answer).agg(F.sum("_sign").alias("_net"))
    return per_answer.groupBy(*request).agg(F.max(F.col("_net") != 0).alias("mismatch"))


def mismatch_rate(differences: DataFrame, day: str) -> DataFrame:
    """Rows ``(day, requests, mismatches, mismatch_pct)``."""
    return differences.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("mismatch").alias("mismatches"),
    ).withColumn(
        "mismatch_pct", F.round(F.col("mismatches").cast("double") / F.col("requests").cast("double") * 100.0, 4)
    )


def rollback_signal(rates: DataFrame, limit_pct: float = ROLLBACK_LIMIT_PCT) -> DataFrame:
    """Days whose mismatch rate calls for a rollback."""
    return rates.filter(F.col("mismatch_pct") > limit_pct)


def exact_p99(calls: DataFrame, group: str, value: str, accuracy: int = 10_000) -> DataFrame:
    """Per group the smallest value that at least 99 of 100 values do not exceed. Rows ``(<group>, p99)``.

    Approximate quantiles only cut the values into three bins. The rank is counted, bin by bin and then inside the one bin it falls
    into, so a poor cut costs time, not the result. What is sorted in one task are the distinct values of that bin, about
    four in ``accuracy`` of all.
    """
    rows = calls.select(F.col(group), F.col(value).alias("_value")).filter(F.col(group).isNotNull() & F.col("_value").isNotNull())
    margin = 2 / accuracy
    cuts = rows.groupBy(group).agg(F.percentile_approx("_value", [0.99 - margin, min(0.99 + margin, 1.0)], accuracy).alias("_cuts"))
    place = F.when(F.col("_value") < F.col("_cuts")[0], 0).when(F.col("_value") <= F.col("_cuts")[1], 1).otherwise(2)
    binned = rows.join(F.broadcast(cuts), group).select(group, "_value", place.alias("_bin"))
    whole = Window.partitionBy(group)
    bins = binned.groupBy(group, "_bin").agg(F.count(F.lit(1)).alias("_n")).select(
        group, "_bin", (F.sum("_n").over(whole.orderBy("_bin")) - F.col("_n")).alias("_before"), "_n",
        F.expr(f"(sum(_n) over (partition by `{group}`) * 99 + 99) div 100").alias("_rank"),
    ).filter("_rank > _before and _rank <= _before + _n").select(group, "_bin", (F.col("_rank") - F.col("_before")).alias("_rank"))
    counts = binned.join(F.broadcast(bins), [group, "_bin"]).groupBy(group, "_rank", "_value").agg(F.count(F.lit(1)).alias("_n"))
    reached = counts.withColumn("_upto", F.sum("_n").over(whole.orderBy("_value"))).filter("_upto >= _rank")
    return reached.groupBy(group).agg(F.min("_value").alias("p99"))


def latency_gate(
    calls: DataFrame, path: str, latency: str, old: str, new: str, factor: float = 1.1, accuracy: int = 10_000
) -> DataFrame:
    """P99 of the new path against ``factor`` times the P99 of the old one, both exact. One row."""
    found = exact_p99(calls.filter(F.col(path).isin(old, new)), path, latency, accuracy)

    def p99(which: str):
        return F.max(F.when(F.col(path) == which, F.col("p99")))

    return found.agg(p99(old).alias("old_p99"), p99(new).alias("new_p99")).withColumn(
        "status", F.when(F.col("new_p99") < F.col("old_p99") * factor, PASSED).otherwise(FAILED)
    )


def missing_prerequisites(required: DataFrame, loaded: DataFrame, on: list[str]) -> DataFrame:
    """Required tables that are not loaded."""
    return required.join(loaded.select(*on), on, "left_anti")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with how many rows carry them.

    The child is counted per key first: a key that holds a third of all rows travels as one row
    per map task. Rows ``(foreign_key, orphan_rows)``.
    """
    per_key = child.filter(F.col(foreign_key).isNotNull()).groupBy(
        F.col(foreign_key).alias("foreign_key")
    ).agg(F.count(F.lit(1)).alias("orphan_rows"))
    parents = parent.select(F.col(parent_key).alias("foreign_key"))
    return per_key.join(parents, "foreign_key", "left_anti")

