"""Five-layer reconciliation of two tables in target form.

Layers 1, 2, 4 and 5 come from one scan per side (``bucket_profile``), layer 3 from one scan of the
target's key columns. Nothing is collected: the report stays a DataFrame of one row per layer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contracts import Contract
from plumbline.functions.digest import BUCKETS, aligned
from plumbline.operators.checksum import COMPARED, bands_differ, checksum_bands
from plumbline.operators.profile import bucket_profile, hashed_rows, profile_aggregates

PASSED, WARNING, FAILED = "PASSED", "WARNING", "FAILED"

# Layer names in report order.
LAYERS = ("row_count", "null_ratio", "pk_uniqueness", "checksum_bands", "statistical_distribution")

SHOWN_KEYS = 5
SHOWN_BUCKETS = 10
TOLERATED_DRIFTED_COLUMNS = 2

# Report messages; {} stands for a number.
SOURCE_EMPTY = "Source is empty — no comparison possible"
NULLS_FINE = "All columns within null-ratio tolerance"
NULLS_DRIFTED = "{} column(s) exceeded {}% null-ratio drift"
KEYS_UNIQUE = "All {} rows have unique PK"
KEYS_REPEAT = "{} duplicate PK combinations found"
KEYS_UNDECLARED = "No primary keys declared — skipping check"
BUCKETS_MATCH = "All {} buckets match between source and target"
BUCKETS_DIFFER = "{} bucket(s) differ — row-level content mismatch"
BUCKETS_UNDEFINED = "No PKs — can't bucket rows"
NO_NUMBERS = "No numeric columns — nothing to compare"
SUMS_FINE = "All {} numeric columns within tolerance"
SUMS_DRIFTED = "{} numeric column(s) drifted beyond {}%"

REPORT_COLUMNS = ("layer", "status", "message", "evidence")


def severity(status: Column) -> Column:
    return F.when(status == FAILED, 2).when(status == WARNING, 1).otherwise(0)


def status_of(rank: Column) -> Column:
    return F.when(rank == 2, FAILED).when(rank == 1, WARNING).otherwise(PASSED)


def _result(layer: str, status: Column, message: Column, evidence: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"),
        status.cast("string").alias("status"),
        message.cast("string").alias("message"),
        evidence.cast("string").alias("evidence"),
    )


def _grouped(n: Column) -> Column:
    return F.format_number(n, 0)


def _filled(template: str, *values) -> Column:
    """Message with its numbers put in, in order."""
    pattern = template.replace("%", "%%").replace("{}", "%s")
    return F.format_string(pattern, *[v.cast("string") if isinstance(v, Column) else F.lit(str(v)) for v in values])


def _percent(part: str, whole: str) -> str:
    """SQL text of a share in percent; nothing of nothing is 0."""
    return f"if({whole} > 0, cast({part} as double) / cast({whole} as double) * 100.0D, 0.0D)"


def paired_totals(
    source: DataFrame, target: DataFrame, contract: Contract, buckets: int = BUCKETS
) -> DataFrame:
    """One row with both sides' counts, NULL counts and sums, and the differing buckets."""
    keys, columns = list(contract.keys), contract.columns
    numeric = contract.numeric_columns
    source, target = aligned(source, target, columns)
    s = bucket_profile(source, keys, columns, numeric, buckets).alias("s")
    t = bucket_profile(target, keys, columns, numeric, buckets).alias("t")
    differs = bands_differ()
    bucket = F.coalesce("s.bucket", "t.bucket")
    shown = F.struct(
        bucket.alias("bucket"), F.col("s.n").alias("source_rows"), F.col("t.n").alias("target_rows")
    )
    totals = [
        F.expr(f"coalesce(sum({side}.`{name}`), 0) as `{side}_{name}`")
        for side in ("s", "t")
        for name in ["n", *[f"null_{c}" for c in columns]]
    ]
    sums = [F.expr(f"sum({side}.`{part}_{c}`) as `{side}_{part}_{c}`") for side in ("s", "t") for part in ("sum", "rest") for c in numeric]
    return s.join(t, F.col("s.bucket") == F.col("t.bucket"), "full_outer").agg(
        *totals,
        *sums,
        F.count_if(differs).alias("n_differing"),
        # At most one entry per bucket.
        F.slice(F.array_sort(F.collect_list(F.when(differs, shown))), 1, SHOWN_BUCKETS).alias("differing"),
    )


def row_count_layer(contract: Contract) -> Column:
    s, t = F.col("s_n"), F.col("t_n")
    diff = F.expr(_percent("abs(s_n - t_n)", "s_n"))
    status = (
        F.when(s == 0, WARNING)
        .when(diff <= contract.count_tolerance_pct, PASSED)
        .otherwise(FAILED)
    )
    message = F.when(s == 0, SOURCE_EMPTY).otherwise(
        F.concat(
            F.lit("source="), _grouped(s), F.lit(" target="), _grouped(t),
            F.lit(" diff="), F.format_string("%.3f", diff), F.lit("%"),
        )
    )
    evidence = F.to_json(F.struct(
        s.alias("source_count"), t.alias("target_count"),
        F.format_string("%.4f", diff).alias("difference_pct"),
        F.lit(str(contract.count_tolerance_pct)).alias("tolerance_pct"),
    ))
    return _result(LAYERS[0], status, message, evidence)


def null_drift_entries(contract: Contract) -> Column:
    """Array of the columns whose NULL share moved by more than the tolerance."""
    entries = []
    for c in contract.columns:
        s, t = _percent(f"`s_null_{c}`", "s_n"), _percent(f"`t_null_{c}`", "t_n")
        entries.append(f"named_struct('column', '{c}', 's', {s}, 't', {t})")
    return F.expr(f"""
        transform(
          filter(array({', '.join(entries)}), x -> abs(x.s - x.t) > {contract.null_drift_points}D),
          x -> named_struct(
            'column', x.column,
            'source_null_pct', format_string('%.2f', x.s),
            'target_null_pct', format_string('%.2f', x.t),
            'drift_pct', format_string('%.2f', abs(x.s - x.t))))""")


def null_drift_layer(contract: Contract) -> Column:
    n = F.size(F.col("null_drifts"))
    status = (
        F.when(n == 0, PASSED).when(n <= TOLERATED_DRIFTED_COLUMNS, WARNING).otherwise(FAILED)
    )
    message = F.when(n == 0, NULLS_FINE).otherwise(_filled(NULLS_DRIFTED, n, contract.null_drift_points))
    return _result(LAYERS[1], status, message, F.when(n > 0, F.to_json("null_drifts")))


def checksum_layer(contract: Contract, buckets: int) -> Column:
    if not contract.keys:
        return _result(LAYERS[3], F.lit(WARNING), F.lit(BUCKETS_UNDEFINED), F.lit(None))
    n = F.col("n_differing")
    return _result(
        LAYERS[3],
        F.when(n == 0, PASSED).otherwise(FAILED),
        F.when(n == 0, BUCKETS_MATCH.format(buckets)).otherwise(_filled(BUCKETS_DIFFER, n)),
        F.when(n > 0, F.to_json("differing")),
    )


def sum_drift_entries(contract: Contract) -> Column:
    """Array of the numeric columns whose sum moved by more than the tolerance.

    A zero source sum has no relative difference; any other target sum is then a drift. Numbers that are too
    large for an exact sum, and NaN, are summed apart and compared by the same rule.
    """
    entries = []
    for c in contract.numeric_columns:
        s, t = (f"cast(coalesce(`{side}_sum_{c}`, 0) as decimal(38,6))" for side in "st")
        rs, rt = (f"coalesce(`{side}_rest_{c}`, 0D)" for side in "st")
        entries.append(f"named_struct('column', '{c}', 's', {s}, 't', {t}, 'rs', {rs}, 'rt', {rt})")
    pct = "if(x.s = 0, null, cast(abs(x.s - x.t) as double) / cast(abs(x.s) as double) * 100.0D)"
    rest_pct = "if(x.rs = 0D, null, abs(x.rs - x.rt) / abs(x.rs) * 100.0D)"
    rest = f"(not (x.rs <=> x.rt) and if(x.rs = 0D, true, {rest_pct} > {contract.sum_drift_pct}D))"
    return F.expr(f"""
        transform(
          filter(array({', '.join(entries)}), x -> if(x.s = 0, x.t <> 0, {pct} > {contract.sum_drift_pct}D) or {rest}),
          x -> named_struct(
            'column', x.column,
            'source_sum', if({rest}, cast(x.rs as string), cast(x.s as string)),
            'target_sum', if({rest}, cast(x.rt as string), cast(x.t as string)),
            'diff_pct', format_string('%.4f', if({rest}, {rest_pct}, {pct}))))""")


def statistics_layer(contract: Contract) -> Column:
    numeric = contract.numeric_columns
    if not numeric:
        return _result(
            LAYERS[4], F.lit(PASSED), F.lit(NO_NUMBERS), F.lit(None)
        )
    n = F.size(F.col("sum_drifts"))
    return _result(
        LAYERS[4],
        F.when(n == 0, PASSED).otherwise(FAILED),
        F.when(n == 0, SUMS_FINE.format(len(numeric))).otherwise(_filled(SUMS_DRIFTED, n, contract.sum_drift_pct)),
        F.when(n > 0, F.to_json("sum_drifts")),
    )


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Keys that occur more than once, most frequent first when limited."""
    repeated = key_counts(df, keys).filter("n > 1")
    return repeated if limit is None else repeated.orderBy(F.desc("n"), *keys).limit(limit)


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``(total_rows, distinct_pks, duplicate_count)`` from one shuffle of the keys."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_pks"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    )


def key_uniqueness_rows(target: DataFrame, contract: Contract) -> DataFrame:
    """Layer 3 as one report row."""
    return _uniqueness_row(_uniqueness(target, list(contract.keys)))


def _uniqueness(target: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``(total, distinct, dups, samples)``; samples is a JSON list of the most frequent repeated keys."""
    totals = key_uniqueness(target, keys).select(
        "total_rows", "distinct_pks", "duplicate_count", F.lit(None).cast("string").alias("sample")
    )
    none = F.lit(None).cast("bigint")
    shown = duplicate_keys(target, keys, SHOWN_KEYS).select(
        none.alias("total_rows"), none.alias("distinct_pks"), none.alias("duplicate_count"),
        F.to_json(F.struct(*keys, F.col("n").alias("count"))).alias("sample"),
    )
    return totals.unionByName(shown).agg(
        F.max("total_rows").alias("total"),
        F.max("distinct_pks").alias("distinct"),
        F.max("duplicate_count").alias("dups"),
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("sample")), ","), F.lit("]")).alias("samples"),
    )


def _uniqueness_row(found: DataFrame, *by: str) -> DataFrame:
    dups = F.col("dups")
    evidence = F.concat(
        F.lit('{"total_rows":'), F.col("total"), F.lit(',"distinct_pks":'), F.col("distinct"),
        F.lit(',"duplicate_count":'), dups, F.lit(',"sample_duplicates":'), F.col("samples"), F.lit("}"),
    )
    result = _result(
        LAYERS[2],
        F.when(dups == 0, PASSED).otherwise(FAILED),
        F.when(dups == 0, _filled(KEYS_UNIQUE, _grouped(F.col("total")))).otherwise(_filled(KEYS_REPEAT, _grouped(dups))),
        F.when(dups > 0, evidence),
    )
    return found.select(*by, F.inline(F.array(result)))


def layer_rows(
    source: DataFrame, target: DataFrame, contract: Contract, buckets: int = BUCKETS
) -> DataFrame:
    """The five results. Both inputs are in target form.

    Where a side lacks declared columns, the shared ones are compared, and the checksum layer
    fails; key uniqueness fails if the target lacks a key.
    """
    shared = [c for c in contract.columns if c in source.columns and c in target.columns]
    missing = [c for c in contract.columns if c not in shared]
    if missing:
        kept = tuple(f for f in contract.fields if f.audit or f.target in shared)
        known = replace(contract, fields=kept, keys=tuple(k for k in contract.keys if k in shared))
        rows = layer_rows(source, target, known, buckets).filter(~F.col("layer").isin(_failed_by(contract, missing)))
        return rows.unionByName(_missing_rows(source.sparkSession, contract, missing))
    uniqueness = key_uniqueness_rows(target, contract) if contract.keys else None
    return _layers(paired_totals(source, target, contract, buckets), uniqueness, contract, buckets)


def _layers(totals: DataFrame, uniqueness: DataFrame | None, contract: Contract, buckets: int, *by: str) -> DataFrame:
    """The results from one row of both sides' totals, and the row of key uniqueness where there are keys.

    Several comparisons are told apart by the columns ``by``.
    """
    wide = (
        totals.withColumn("null_drifts", null_drift_entries(contract))
        .withColumn("sum_drifts", sum_drift_entries(contract) if contract.numeric_columns else F.array())
    )
    in_scan = [
        row_count_layer(contract),
        null_drift_layer(contract),
        checksum_layer(contract, buckets),
        statistics_layer(contract),
    ]
    if uniqueness is not None:
        return wide.select(*by, F.inline(F.array(*in_scan))).unionByName(uniqueness)
    skipped = _result(
        LAYERS[2], F.lit(WARNING), F.lit(KEYS_UNDECLARED), F.lit(None)
    )
    return wide.select(*by, F.inline(F.array(*in_scan, skipped)))


def measured(sides: dict[str, tuple[DataFrame, bool]], contract: Contract) -> dict[str, dict]:
    """Totals of several tables in target form, and their key uniqueness where asked for: two rows of each, in one job."""
    parts = []
    for name, (df, unique) in sides.items():
        rows = hashed_rows(df, contract.columns, contract.numeric_columns)
        parts.append(rows.agg(*profile_aggregates(df, contract.columns, contract.numeric_columns)).withColumn("_side", F.lit(name)))
        if unique and contract.keys:
            parts.append(_uniqueness(df, list(contract.keys)).withColumn("_side", F.lit(name)))
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).collect()
    out: dict[str, dict] = {name: {} for name in sides}
    for row in found:
        out[row["_side"]].update({k: v for k, v in row.asDict().items() if v is not None and k != "_side"})
    return out


def lanes_match(source: dict, target: dict) -> bool:
    return all((source.get(c) or 0) == (target.get(c) or 0) for c in COMPARED)


def reports_of(
    spark: SparkSession, pairs: dict[str, tuple[dict, dict, Callable[[], DataFrame]]], contract: Contract, batch_id: str, buckets: int = BUCKETS,
) -> dict[str, list[dict]]:
    """Reports of pairs of tables whose totals are known, as ``reconcile`` gives them.

    A pair is the source's totals, the target's, and what gives the bands of both. Tables of one checksum in all
    have it in every bucket; only where the checksums differ the bands are asked for, and at most `buckets` rows of them are collected.
    """
    fields = ["_pair string", "n_differing long", "differing array<struct<bucket:int,source_rows:bigint,target_rows:bigint>>"]
    for side in ("s", "t"):
        fields += [f"`{side}_{name}` long" for name in ["n", *[f"null_{c}" for c in contract.columns]]]
        for c in contract.numeric_columns:
            fields += [f"`{side}_sum_{c}` decimal(38,6)", f"`{side}_rest_{c}` double"]
    rows, keys = [], []
    for name, (source, target, bands) in pairs.items():
        shown, n_differing = [], 0
        if not lanes_match(source, target):
            found = bands().filter("differs").select("bucket", "source_count", "target_count").orderBy("bucket").collect()
            # Sides that differed when they were measured still differ, whatever a second look finds.
            n_differing, shown = max(1, len(found)), [tuple(r) for r in found[:SHOWN_BUCKETS]]
        row = [name, n_differing, shown]
        for values in (source, target):
            row += [values.get(c) or 0 for c in ["n", *[f"null_{c}" for c in contract.columns]]]
            row += [values.get(f"{part}_{c}") for c in contract.numeric_columns for part in ("sum", "rest")]
        rows.append(tuple(row))
        keys.append((name, target.get("total", 0), target.get("distinct", 0), target.get("dups", 0), target.get("samples", "[]")))
    totals = spark.createDataFrame(rows, ", ".join(fields))
    uniqueness = None
    if contract.keys:
        uniqueness = _uniqueness_row(spark.createDataFrame(keys, "_pair string, total long, distinct long, dups long, samples string"), "_pair")
    reports: dict[str, list[dict]] = {name: [] for name in pairs}
    for r in _layers(totals, uniqueness, contract, buckets, "_pair").collect():
        layer = r.asDict()
        reports[layer.pop("_pair")].append({"contract_fqn": contract.fqn, "batch_id": batch_id, **layer})
    return reports


def bands_of(source: DataFrame, target: DataFrame, contract: Contract, buckets: int = BUCKETS) -> DataFrame:
    return checksum_bands(source, target, list(contract.keys), contract.columns, buckets)


def _failed_by(contract: Contract, missing: list[str]) -> list[str]:
    return [LAYERS[3], *([LAYERS[2]] if set(missing) & set(contract.keys) else [])]


def _missing_rows(spark: SparkSession, contract: Contract, missing: list[str]) -> DataFrame:
    text = f"Column(s) not on both sides: {', '.join(missing)}"
    rows = [(layer, FAILED, text, None) for layer in _failed_by(contract, missing)]
    return spark.createDataFrame(rows, "layer string, status string, message string, evidence string")


def report_header(rows: DataFrame, contract: Contract, batch_id: str, at: datetime | None = None) -> DataFrame:
    """One row per report: the worst status, with the layers nested in report order."""
    def counted(side: str) -> Column:
        evidence = F.when(F.col("layer") == LAYERS[0], F.col("evidence"))
        return F.get_json_object(evidence, f"$.{side}_count").cast("bigint")

    order = F.create_map(*[F.lit(v) for pair in ((n, i) for i, n in enumerate(LAYERS)) for v in pair])
    return rows.agg(
        status_of(F.max(severity(F.col("status")))).alias("overall_status"),
        *[F.max(counted(side)).alias(f"{side}_row_count") for side in ("source", "target")],
        F.array_sort(F.collect_list(F.struct(
            order[F.col("layer")].alias("position"), *[F.col(c) for c in REPORT_COLUMNS]
        ))).alias("layers"),
    ).select(
        F.lit(contract.fqn).alias("contract_fqn"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(at or datetime.now(timezone.utc)).cast("timestamp").alias("validated_at"),
        "overall_status",
        "source_row_count",
        "target_row_count",
        F.transform("layers", lambda x: F.struct(*[x[c].alias(c) for c in REPORT_COLUMNS])).alias("results"),
    )


def overall(rows: DataFrame, warnings_count: bool = True) -> DataFrame:
    """One row ``(overall_status)``. Three-way checks ignore warnings."""
    rank = severity(F.col("status"))
    if not warnings_count:
        rank = F.when(rank == 2, 2).otherwise(0)
    return rows.agg(status_of(F.coalesce(F.max(rank), F.lit(0))).alias("overall_status"))


def reconcile(
    source: DataFrame, target: DataFrame, contract: Contract, batch_id: str, buckets: int = BUCKETS
) -> DataFrame:
    """Report rows ``(contract_fqn, batch_id, layer, status, message, evidence)``."""
    return layer_rows(source, target, contract, buckets).select(
        F.lit(contract.fqn).alias("contract_fqn"), F.lit(batch_id).alias("batch_id"), *REPORT_COLUMNS
    )


def loaded_since(df: DataFrame, batch_start) -> DataFrame:
    """Only rows this batch has loaded: residue of an earlier failed batch does not count."""
    return df.filter(F.col("_loaded_at") > F.lit(batch_start))
