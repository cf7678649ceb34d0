"""Registered queries: every operator over the given tables, by name.

Each entry takes a session and a folder of tables and gives a DataFrame over whole tables. Times
come back without a zone.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import Contract, Field
from plumbline.mdm import ACTIVITY, CUSTOMER, MATERIAL, ORDERS, PRICE_HISTORY, VENDOR
from plumbline.operators import checksum, digest_tree, incremental, ledger, merge, monitor, parity, pii, reconcile, rules, sketches
from plumbline.operators.profile import table_profile
from plumbline.operators.transform import (
    coercion_findings, expand_lookup, mask_personal, normalise, rename_only, schema_conformance, with_extract_audit,
    with_load_audit,
)
from plumbline.plans import runs
from plumbline.session import scratch_dir
from plumbline.sinks import clustered
from plumbline.sinks import files as sink_files
from plumbline.sinks import jdbc as sink_jdbc
from plumbline.sinks.ledger import Ledger
from plumbline.sinks.versioned import VersionedTable
from plumbline.sources import files, jdbc, shaped
from plumbline.sources.files import table
from plumbline.streaming import cdc, evolution
from plumbline.streaming.debounce import debounced_stream, first_arrivals_stream
from plumbline.streaming.queue import QueueReader

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_AT = datetime(2031, 9, 5, 3, 40, 12, tzinfo=timezone.utc)
BATCH = "batch-0905"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as plain wall-clock values."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def utc_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as UTC wall-clock values, whatever the session's zone."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return df.withColumns({c: F.to_utc_timestamp(c, zone).cast("timestamp_ntz") for c in columns})


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def materials(spark, sf):
    return normalise(shaped.materials(spark, sf), MATERIAL)


def customers(spark, sf):
    return normalise(shaped.customers(spark, sf), CUSTOMER)


def vendors(spark, sf):
    return normalise(shaped.vendors(spark, sf), VENDOR)


def prices(spark, sf):
    return normalise(shaped.price_history(spark, sf), PRICE_HISTORY)


def orders_and_damaged(spark, sf, *kinds):
    clean = shaped.normalised_orders(spark, sf)
    return clean, shaped.damaged_orders(clean, *kinds)


ALL_DAMAGE = ("dropped", "nulled", "duplicated", "scaled", "swapped")
ORDER_KEYS = list(ORDERS.keys)


# --- projections -----------------------------------------------------------------------------


@query
def material_normalise(spark, sf):
    return materials(spark, sf)


@query
def customer_normalise(spark, sf):
    return customers(spark, sf)


@query
def customer_masked(spark, sf):
    return mask_personal(customers(spark, sf), CUSTOMER)


@query
def vendor_normalise(spark, sf):
    return vendors(spark, sf)


@query
def price_history_build(spark, sf):
    return zoneless(prices(spark, sf))


@query
def rename_columns(spark, sf):
    return rename_only(shaped.materials(spark, sf), MATERIAL)


@query
def typed_values(spark, sf):
    """Every declared number and time type, read from text that is sometimes malformed."""
    key = F.col("l_linenumber")
    bad = F.col("l_orderkey") % 13 == 0
    text = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("A"),
        F.when(bad, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("B"),
        F.when(bad, "12345678901.1").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("C"),
        F.col("l_quantity").cast("int").cast("string").alias("D"),
        F.when(bad, "2031-09-05").otherwise(F.date_format("l_shipdate", "yyyyMMdd")).alias("E"),
        F.concat(F.lpad(key.cast("string"), 2, "0"), F.lit("3015")).alias("F"),
        F.when(bad, "20261341").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("G"),
        F.concat(F.col("l_returnflag"), F.lit("  ")).alias("H"),
        F.concat(F.col("l_linestatus"), F.lit("  ")).alias("I"),
    )
    fields = (
        Field("A", "a_bigint", "BIGINT"), Field("B", "b_integer", "INTEGER"),
        Field("C", "c_decimal", "DECIMAL", precision=10, scale=2), Field("D", "d_double", "DOUBLE"),
        Field("E", "e_date", "DATE"), Field("F", "f_time", "TIME"), Field("G", "g_timestamp", "TIMESTAMP"),
        Field("H", "h_text", "NVARCHAR"), Field("I", "i_clob", "CLOB"), Field("NONE", "j_missing", "DECIMAL", precision=9, scale=2),
    )
    contract = Contract("DW", "T", "TYPES", "t.types", "t.types", ("a_bigint",), fields)
    return zoneless(normalise(text, contract))


@query
def lookup_expand(spark, sf):
    nation = table(spark, sf, "nation").select(
        shaped.country_code(F.col("n_nationkey")).alias("code"), F.col("n_name"), F.col("n_regionkey").alias("region_code")
    )
    region = table(spark, sf, "region")
    named = expand_lookup(nation, region, "region_code", "r_regionkey", "r_name", "region_name")
    base = customers(spark, sf).select("customer_number", "country_code")
    withname = expand_lookup(base, named, "country_code", "code", "n_name", "country_name")
    return expand_lookup(withname, named, "country_code", "code", "region_name", "region_name")


@query
def schema_check(spark, sf):
    """Conformance of a table with one column missing, one of another type, and some keys lost."""
    df = materials(spark, sf).drop("weight_unit").withColumns({
        "gross_weight": F.col("gross_weight").cast("double"),
        "material_number": F.when(F.col("gross_weight") < 40, F.col("material_number")),
    })
    return schema_conformance(df, MATERIAL)


@query
def coercion_losses(spark, sf):
    return coercion_findings(shaped.customers(spark, sf), CUSTOMER)


@query
def extract_audit(spark, sf):
    raw = shaped.vendors(spark, sf)
    audited = with_extract_audit(raw, VENDOR, RUN_AT)
    return utc_clock(normalise(audited, VENDOR), "_extracted_at")


@query
def load_audit(spark, sf):
    return utc_clock(with_load_audit(vendors(spark, sf), VENDOR, BATCH, RUN_AT), "_extracted_at", "_loaded_at")


# --- profiles and reconciliation -------------------------------------------------------------


@query
def profile_lineitem(spark, sf):
    df = table(spark, sf, "lineitem")
    return table_profile(df, ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"], quantiles=False)


@query
def profile_orders(spark, sf):
    _, damaged = orders_and_damaged(spark, sf, "nulled")
    return table_profile(damaged, ["order_key", "total_price", "order_priority"], quantiles=False)


@query
def profile_part(spark, sf):
    return table_profile(table(spark, sf, "part"), ["p_partkey", "p_size", "p_retailprice", "p_brand"])


@query
def profile_quantiles(spark, sf):
    """Medians and 95th percentiles within one rank in 10,000."""
    df = table(spark, sf, "lineitem")
    rows = table_profile(df, ["l_orderkey", "l_quantity", "l_extendedprice"])
    return rows.select("column_name", "n_rows", "median_value", "p95_value")


@query
def quantile_rank_errors(spark, sf):
    """Whether the sketched quantiles lie within their rank error, of all rows counted exactly."""
    df = table(spark, sf, "lineitem")
    columns = ["l_orderkey", "l_quantity", "l_extendedprice"]
    found = {r["column_name"]: r for r in table_profile(df, columns).collect()}
    checks = []
    for c in columns:
        tests = []
        for share, value in ((0.5, found[c]["median_value"]), (0.95, found[c]["p95_value"])):
            below, upto = F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value)
            n, slack = F.count(c), F.count(c) / 10_000 + 1
            tests.append((below - slack <= n * share) & (n * share <= upto + slack))
        checks.append(F.struct(F.lit(c).alias("column_name"), tests[0].alias("median_ok"), tests[1].alias("p95_ok")))
    return df.agg(F.array(*checks).alias("c")).select(F.inline("c"))


def month_sketches(spark, sf):
    """Sketches of two line columns, stored per month of shipping and read back."""
    path = scratch_dir(spark, "sketches")
    lines = table(spark, sf, "lineitem")
    sketches.period_sketches(lines, F.date_format("l_shipdate", "yyyy-MM"), ["l_quantity", "l_extendedprice"]).write.parquet(path)
    return spark.read.parquet(path)


@query
def sketch_periods(spark, sf):
    """Values in each month's sketch, and in those of each year merged."""
    months = month_sketches(spark, sf)
    years = sketches.merged(months.withColumn("year", F.substring("period", 1, 4)), "year").withColumnRenamed("year", "period")
    return months.unionByName(years).select("period", "column_name", F.kll_sketch_get_n_double("sketch").alias("n"))


@query
def merged_quantiles(spark, sf):
    """Quantiles of all lines from their months' sketches."""
    return sketches.quantiles(sketches.merged(month_sketches(spark, sf)), [0.01, 0.5, 0.95, 0.99])


def one_layer(spark, sf, layer, *kinds):
    source, target = orders_and_damaged(spark, sf, *kinds)
    return reconcile.layer_rows(source, target, ORDERS).filter(F.col("layer") == layer)


@query
def recon_row_count(spark, sf):
    return one_layer(spark, sf, "row_count", "dropped")


@query
def recon_null_drift(spark, sf):
    return one_layer(spark, sf, "null_ratio", "nulled")


@query
def recon_pk_unique(spark, sf):
    return one_layer(spark, sf, "pk_uniqueness", "duplicated")


@query
def recon_stats(spark, sf):
    return one_layer(spark, sf, "statistical_distribution", "scaled")


@query
def recon_checksum_bands(spark, sf):
    source, target = orders_and_damaged(spark, sf, "swapped")
    return checksum.checksum_bands(source, target, ORDER_KEYS, ORDERS.columns)


@query
def recon_drilldown(spark, sf):
    source, target = orders_and_damaged(spark, sf, *ALL_DAMAGE)
    return checksum.drill_down(source, target, ORDER_KEYS, ORDERS.columns)


@query
def recon_report(spark, sf):
    source, target = orders_and_damaged(spark, sf, *ALL_DAMAGE)
    return reconcile.reconcile(source, target, ORDERS, BATCH)


@query
def recon_report_swapped(spark, sf):
    """Exchanged values keep counts, NULLs, keys and sums: only the checksums notice."""
    source, target = orders_and_damaged(spark, sf, "swapped")
    return reconcile.reconcile(source, target, ORDERS, BATCH).drop("evidence")


@query
def recon_report_tolerant(spark, sf):
    source, target = orders_and_damaged(spark, sf, *ALL_DAMAGE)
    contract = ORDERS.with_tolerances(count_tolerance_pct=2.0, null_drift_points=10.0, sum_drift_pct=100.0)
    return reconcile.reconcile(source, target, contract, BATCH).drop("evidence")


@query
def recon_overall(spark, sf):
    source, target = orders_and_damaged(spark, sf, "nulled")
    header = reconcile.report_header(reconcile.layer_rows(source, target, ORDERS), ORDERS, BATCH, RUN_AT)
    return utc_clock(header.withColumn("results", F.size("results")), "validated_at")


@query
def recon_missing_column(spark, sf):
    """A target that lost a column: the rest is still compared."""
    source, target = orders_and_damaged(spark, sf, "scaled")
    return reconcile.layer_rows(source, target.drop("order_status"), ORDERS).select("layer", "status")


@query
def duplicate_keys(spark, sf):
    return reconcile.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dup_key_evidence(spark, sf):
    return reconcile.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], reconcile.SHOWN_KEYS)


@query
def exact_diff(spark, sf):
    source, target = orders_and_damaged(spark, sf, *ALL_DAMAGE)
    return checksum.exact_difference(source, target)


WINDOW = (date(1996, 1, 1), date(1999, 12, 31))


@query
def window_parity(spark, sf):
    source, target = orders_and_damaged(spark, sf, "dropped")
    return incremental.window_parity(*[incremental.in_window(d, "order_date", *WINDOW) for d in (source, target)])


@query
def window_pk_unique(spark, sf):
    _, target = orders_and_damaged(spark, sf, "duplicated")
    return incremental.window_key_uniqueness(incremental.in_window(target, "order_date", *WINDOW), ORDER_KEYS)


@query
def stale_row_check(spark, sf):
    source, target = orders_and_damaged(spark, sf, "scaled", "nulled")
    return incremental.stale_rows(source, target, ORDERS, WINDOW[0])


@query
def pk_spot_check(spark, sf):
    clean, damaged = orders_and_damaged(spark, sf, "dropped")
    return incremental.spot_check(damaged, clean, ORDER_KEYS, seed=7)


@query
def run_incremental(spark, sf):
    source, target = orders_and_damaged(spark, sf, "dropped", "duplicated")
    return runs.run_incremental(source, target, ORDERS, *WINDOW)


@query
def run_incremental_overall(spark, sf):
    return incremental.window_overall(run_incremental(spark, sf))


def customer_copies(spark, sf):
    """Raw rows, an operational copy with some cities changed, an analytical copy with rows lost."""
    raw = customers(spark, sf)
    number = F.col("customer_number").cast("bigint")
    operational = raw.withColumn("city", F.when(number % 100 == 5, F.lower("city")).otherwise(F.col("city")))
    analytical = mask_personal(raw.filter(number % 40 != 0), CUSTOMER)
    return raw, operational, analytical


@query
def three_way_parity(spark, sf):
    return parity.three_way(*customer_copies(spark, sf), CUSTOMER).select("comparison", "layer", "status")


@query
def run_post_load(spark, sf):
    return runs.run_post_load(*customer_copies(spark, sf), CUSTOMER)


@query
def three_way_status(spark, sf):
    return parity.three_way_overall(parity.three_way(*customer_copies(spark, sf), CUSTOMER))


def shadow_rates(spark, sf):
    old = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_id", "value")
    changed = F.when(F.col("event_id") % 250 == 0, F.col("value") + 1).otherwise(F.col("value"))
    new = old.filter(F.col("event_id") % 400 != 7).withColumn("value", changed)
    return parity.mismatch_rate(parity.shadow_differences(old, new, ["day", "event_id"], ["value"]), "day")


@query
def shadow_diff_rate(spark, sf):
    return shadow_rates(spark, sf)


@query
def rollback_signal(spark, sf):
    return parity.rollback_signal(shadow_rates(spark, sf), limit_pct=0.7)


@query
def latency_gate(spark, sf):
    return parity.latency_gate(table(spark, sf, "events"), "event_type", "value", "view", "click")


@query
def orphan_check(spark, sf):
    parents = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return parity.orphans(table(spark, sf, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query
def prerequisite_check(spark, sf):
    """Customer segments need their nations served: which lack a supplier of means?"""
    required = table(spark, sf, "customer").select("c_mktsegment", F.col("c_nationkey").alias("nation")).distinct()
    loaded = table(spark, sf, "supplier").filter("s_acctbal > 8000").select(F.col("s_nationkey").alias("nation")).distinct()
    return parity.missing_prerequisites(required, loaded, ["nation"])


# --- rules and masking -----------------------------------------------------------------------


@query
def rules_suite(spark, sf):
    return rules.run_rules(customers(spark, sf), rules.contract_suite(CUSTOMER))


@query
def rules_composite_key(spark, sf):
    return rules.run_rules(prices(spark, sf), rules.contract_suite(PRICE_HISTORY))


@query
def rules_single_columns(spark, sf):
    return rules.run_rules(prices(spark, sf), rules.contract_suite(PRICE_HISTORY, composite_key=False))


@query
def rules_extended(spark, sf):
    data = {MATERIAL: materials, CUSTOMER: customers, VENDOR: vendors, PRICE_HISTORY: prices}
    parts = None
    for contract, build in data.items():
        rows = rules.run_rules(build(spark, sf), list(rules.EXTENDED_RULES[contract.analytical]))
        rows = rows.select(F.lit(contract.analytical).alias("table_name"), "*")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def rules_unknown(spark, sf):
    suite = [rules.Rule("expect_the_unexpected", ("email",)), rules.Rule(rules.NOT_NULL, ("no_such_column",)),
             rules.Rule(rules.NOT_NULL, ("email",))]
    return rules.run_rules(customers(spark, sf), suite)


@query
def rules_status(spark, sf):
    suite = list(rules.EXTENDED_RULES[CUSTOMER.analytical])
    return rules.suite_status(rules.run_rules(customers(spark, sf), suite))


@query
def predicate_counts(spark, sf):
    df = customers(spark, sf)
    email = rules.Rule(rules.MATCH_REGEX, ("email",), pattern=rules.EMAIL_PATTERN)
    strict = rules.Rule(rules.MATCH_REGEX, ("email",), pattern=rules.EMAIL_PATTERN, nulls_violate=True)
    flags = rules.Rule(rules.IN_SET, ("is_deletion_flag",), values=("true",))
    scoped = rules.Rule(rules.NOT_NULL, ("fax",), where="country_code = 'US'")
    return df.agg(
        F.count_if(F.col("email").isNull()).alias("null_emails"),
        F.count_if(F.col("email").isNotNull()).alias("filled_emails"),
        F.count_if(rules.violated(email)).alias("bad_emails"),
        F.count_if(rules.violated(strict)).alias("bad_or_null_emails"),
        F.count_if(rules.violated(flags)).alias("flags_not_true"),
        F.count_if(rules.violated(scoped)).alias("us_without_fax"),
        F.count_if(~F.col("fax").eqNullSafe(F.col("phone_primary"))).alias("fax_differs"),
    )


def leaky_customers(spark, sf):
    """A masked copy in which every phone number is raw, and one e-mail address in 30."""
    raw = customers(spark, sf)
    number = F.col("customer_number").cast("bigint")
    masked = mask_personal(raw, CUSTOMER)
    plain = raw.select("customer_number", F.struct("phone_primary", "email").alias("_raw"))
    joined = masked.join(plain, "customer_number")
    return joined.withColumns({
        "phone_primary": F.col("_raw.phone_primary"),
        "email": F.when(number % 30 == 1, F.col("_raw.email")).otherwise(F.col("email")),
        "fax": F.lit(None).cast("string"),
    }).drop("_raw")


@query
def pii_audit(spark, sf):
    return pii.audit_columns(leaky_customers(spark, sf), CUSTOMER.analytical, CUSTOMER.personal_columns)


@query
def run_pii_audit(spark, sf):
    tables = [(CUSTOMER, leaky_customers(spark, sf)), (VENDOR, vendors(spark, sf))]
    return pii.audit_status(runs.run_pii_audit(tables))


@query
def bounded_scan(spark, sf):
    return pii.bounded_values(customers(spark, sf), "email")


# --- merges ----------------------------------------------------------------------------------

SINCE = "2000-06-01"


def orders_and_changes(spark, sf):
    clean = shaped.normalised_orders(spark, sf)
    return clean, shaped.order_changes(clean, SINCE)


@query
def upsert_orders(spark, sf):
    clean, changes = orders_and_changes(spark, sf)
    older = changes.withColumn("order_status", F.lit("B"))
    versions = changes.withColumn("_rev", F.lit(2)).unionByName(older.withColumn("_rev", F.lit(1)))
    return merge.upsert(clean, versions, ORDER_KEYS, order=["_rev"])


@query
def upsert_keys_only(spark, sf):
    clean, changes = orders_and_changes(spark, sf)
    twice = changes.unionByName(changes).select("order_key")
    return merge.upsert(clean.select("order_key"), twice, ORDER_KEYS)


@query
def delete_insert_orders(spark, sf):
    return merge.delete_insert(*orders_and_changes(spark, sf), ORDER_KEYS)


@query
def delete_using_orders(spark, sf):
    return merge.delete_using(*orders_and_changes(spark, sf), ORDER_KEYS)


@query
def merge_full_outer(spark, sf):
    return merge.merge_matched(*orders_and_changes(spark, sf), ORDER_KEYS)


CDC_COLUMNS = ["USER_ID", "EVENT_TYPE", "AMOUNT"]


def half_feeds(spark, sf):
    """The change feed in two parts that overlap in time, as late arrivals would make it."""
    feed = shaped.change_feed(spark, sf)
    late = F.col("_seq") % 3 == 0
    return feed.filter(~late), feed.filter(late)


@query
def cdc_latest(spark, sf):
    return merge.latest_per_key(shaped.change_feed(spark, sf), ["USER_ID"], cdc.ORDER)


def silver(spark, sf):
    first, late = [merge.to_versions(f, CDC_COLUMNS, cdc.ORDER) for f in half_feeds(spark, sf)]
    state = merge.apply_changes(None, first, ["USER_ID"], cdc.ORDER)
    return merge.apply_changes(state, late, ["USER_ID"], cdc.ORDER)


@query
def cdc_silver(spark, sf):
    return silver(spark, sf)


@query
def cdc_current(spark, sf):
    return merge.current_rows(silver(spark, sf))


def write_feed(spark, sf, path):
    """The change feed as two batches of files, out of order in time."""
    for part in half_feeds(spark, sf):
        stored = part.withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp"))
        stored.write.mode("append").parquet(path)


STORED = {"USER_ID": T.LongType(), "AMOUNT": T.DoubleType()}


def streamed(spark, sf, purpose):
    root = scratch_dir(spark, purpose)
    write_feed(spark, sf, f"{root}/feed")
    return root, cdc.feed_schema(ACTIVITY, STORED)


@query
def bronze_stream(spark, sf):
    root, schema = streamed(spark, sf, "bronze")
    # The second run finds nothing new.
    for _ in range(2):
        cdc.ingest_bronze(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt", schema).awaitTermination()
    bronze = spark.read.schema(cdc.bronze_schema(schema)).parquet(f"{root}/bronze")
    return zoneless(bronze.drop("_cdc_ingested_at", "_cdc_source_file"))


@query
def bronze_audit_columns(spark, sf):
    """For every bronze row, which of two runs its ingest time falls in, and whether the file it names holds it."""
    root = scratch_dir(spark, "bronze-audit")
    schema = cdc.feed_schema(ACTIVITY, STORED)
    times = [time.time_ns() // 1_000_000]
    for part in half_feeds(spark, sf):
        part.select(*schema.names).withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp")).write.mode("append").parquet(f"{root}/feed")
        cdc.ingest_bronze(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt", schema).awaitTermination()
        times.append(time.time_ns() // 1_000_000)
    ingested = F.unix_millis("_cdc_ingested_at")
    run = F.coalesce(*(F.when((ingested >= start) & (ingested < end), i) for i, (start, end) in enumerate(pairwise(times), 1)))
    bronze = spark.read.schema(cdc.bronze_schema(schema)).parquet(f"{root}/bronze")
    files = spark.read.schema(schema).parquet(f"{root}/feed").select("_seq", F.col("_metadata.file_path").alias("file")).distinct()
    return (bronze.select("_seq", run.alias("ingest_run"), F.col("_cdc_source_file").alias("named")).join(files, "_seq", "left")
            .select("_seq", "ingest_run", F.coalesce(F.col("file") == F.col("named"), F.lit(False)).alias("in_its_file")))


@query
def schema_evolution_stream(spark, sf):
    """The feed gains a column between two runs; the stream is restarted with the wider schema."""
    root = scratch_dir(spark, "evolution")
    narrow = replace(ACTIVITY, fields=tuple(f for f in ACTIVITY.fields if f.target != "email"))
    for part, contract in zip(half_feeds(spark, sf), (narrow, ACTIVITY)):
        schema = cdc.feed_schema(contract, STORED)
        stored = part.withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp"))
        stored.select(*schema.names).write.mode("append").parquet(f"{root}/feed")
        cdc.ingest_bronze(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt", schema).awaitTermination()
    bronze = spark.read.schema(cdc.bronze_schema(schema)).parquet(f"{root}/bronze")
    return zoneless(bronze.drop("_cdc_ingested_at", "_cdc_source_file"))


@query
def schema_found_in_files(spark, sf):
    """Change files gain a column nobody declared, then the contract declares it; no schema is widened by hand."""
    root = scratch_dir(spark, "found")
    narrow = replace(ACTIVITY, fields=tuple(f for f in ACTIVITY.fields if f.target != "email"))
    feed = shaped.change_feed(spark, sf).withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp"))
    names = cdc.feed_schema(ACTIVITY, STORED).names
    stream = evolution.EvolvingFeed(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt")
    for i, contract in enumerate((narrow, narrow, ACTIVITY)):
        part = feed.filter(F.col("_seq") % 3 == i).select(*names)
        (part.drop("EMAIL") if i == 0 else part).write.mode("append").parquet(f"{root}/feed")
        stream.ingest(contract, STORED)
    bronze = stream.read(ACTIVITY, STORED)
    filled = evolution.with_rescued(bronze.withColumn("declared_email", F.col("EMAIL")), "EMAIL")
    return zoneless(filled.select(*names, "declared_email", F.col(evolution.RESCUED)["EMAIL"].alias("rescued_email")))


@query
def cdc_silver_stream(spark, sf):
    root, schema = streamed(spark, sf, "silver")
    state = runs.run_cdc(spark, ACTIVITY, f"{root}/feed", root, schema, buckets=4, max_files=1)
    return zoneless(state.read())


@query
def run_cdc(spark, sf):
    """Two runs over a growing feed; deleted users are left out of the result."""
    root = scratch_dir(spark, "cdc")
    schema = cdc.feed_schema(ACTIVITY, STORED)
    for part in half_feeds(spark, sf):
        stored = part.withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp"))
        stored.write.mode("append").parquet(f"{root}/feed")
        state = runs.run_cdc(spark, ACTIVITY, f"{root}/feed", root, schema, buckets=4)
    return zoneless(merge.current_rows(state.read()))


@query
def dual_target_stream(spark, sf):
    root, schema = streamed(spark, sf, "dual")
    cdc.ingest_bronze(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt", schema).awaitTermination()
    sides = {
        side: VersionedTable(spark, f"{root}/{side}", cdc.silver_schema(ACTIVITY), ["user_id"], 4)
        for side in ("operational", "analytical")
    }
    cdc.feed_targets(
        spark, f"{root}/bronze", sides["operational"], sides["analytical"], f"{root}/ckpt", ACTIVITY,
        cdc.bronze_schema(schema),
    ).awaitTermination()
    rows = [t.read().select(F.lit(side).alias("side"), "user_id", "email", "_is_deleted") for side, t in sides.items()]
    return rows[0].unionByName(rows[1])


@query
def two_cadence_stream(spark, sf):
    """Silver's changes followed by two targets: one keeps up with every part, the other takes all of it at the end."""
    root = scratch_dir(spark, "cadences")
    schema = cdc.feed_schema(ACTIVITY, STORED)
    silver, operational, analytical = (
        VersionedTable(spark, f"{root}/{n}", cdc.silver_schema(ACTIVITY), ["user_id"], 4) for n in ("silver", "operational", "analytical"))
    for part in half_feeds(spark, sf):
        stored = part.withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp"))
        stored.write.mode("append").parquet(f"{root}/feed")
        cdc.ingest_bronze(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt", schema).awaitTermination()
        cdc.merge_silver(spark, f"{root}/bronze", silver, f"{root}/ckpt", ACTIVITY, cdc.bronze_schema(schema), changes_dir=f"{root}/changes").awaitTermination()
        cdc.follow_changes(spark, f"{root}/changes", operational, f"{root}/ckpt/operational", ACTIVITY).awaitTermination()
    cdc.follow_changes(spark, f"{root}/changes", analytical, f"{root}/ckpt/analytical", ACTIVITY, masked=True).awaitTermination()
    rows = [t.read().select(F.lit(side).alias("side"), "user_id", "email", "_is_deleted")
            for side, t in (("operational", operational), ("analytical", analytical))]
    return rows[0].unionByName(rows[1])


def arrivals(spark, sf):
    """Events as object arrivals; clicks fall outside the change area."""
    area = F.when(F.col("event_type") == "click", "raw").otherwise("cdc")
    path = F.concat_ws(
        "/", area, F.lit("sap"), F.concat(F.lit("T"), (F.col("user_id") % 5).cast("string")),
        F.date_format("ts", "yyyy/MM/dd/HH"), F.concat(F.col("event_id").cast("string"), F.lit(".parquet")),
    )
    return table(spark, sf, "events").select("ts", path.alias("path"))


@query
def debounce_5min(spark, sf):
    return monitor.debounced(arrivals(spark, sf), "ts", "path")


@query
def debounce_stream(spark, sf):
    root = scratch_dir(spark, "debounce")
    arrived = arrivals(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    # One micro-batch takes all files there are, so no arrival is late, however many files they lie in.
    arrived.repartitionByRange("ts").write.parquet(f"{root}/arrivals")
    stream = debounced_stream(spark.readStream.schema(arrived.schema).parquet(f"{root}/arrivals"))
    (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt")
        .trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    )
    return zoneless(spark.read.schema(stream.schema).parquet(f"{root}/out").select("table_name", "period_start"))


FILE_ROWS = 250_000


def write_triggers(arrived, close, triggers, staged, path, file_rows=FILE_ROWS):
    """Arrivals as files for a stream: each trigger's are written after those of the one before, as many for each. Gives how many.

    All are computed once, by all tasks. The files follow from the trigger with the fewest rows, ``file_rows`` to a file. Of so many rows some
    task deals out at least one to every file, as long as there are no more tasks than that: no file is left out for being empty.
    """
    arrived.select("ts", "path", "trigger").write.partitionBy("trigger").parquet(staged)
    stored = arrived.sparkSession.read.schema(arrived.select("ts", "path", "trigger").schema).parquet(staged)
    rows = {r["trigger"]: r["count"] for r in stored.groupBy("trigger").count().collect()}
    files = max(1, min(rows.get(k, 0) for k in range(triggers)) // file_rows)
    for k in range(triggers):
        stored.filter(F.col("trigger") == k).select("ts", "path").repartition(files).write.mode("append").parquet(path)
    close.coalesce(1).write.mode("append").parquet(path)
    return files


@query
def debounce_stream_late(spark, sf):
    """Arrivals in five triggers by their time, one in 50 a trigger late, one in 70 three; the first arrival of each table and period.

    A period is open until the trigger after the one that moved the watermark past it: what comes later is dropped. A sixth trigger holds an arrival of no table that closes the last periods.
    """
    root = scratch_dir(spark, "debounce-late")
    arrived = arrivals(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("event_id", F.regexp_extract("path", r"/(\d+)\.parquet$", 1).cast("long"))
    low, high = arrived.agg(F.min("ts"), F.max("ts")).first()
    since = lambda t: F.unix_micros(t) - F.unix_micros(F.lit(low))
    trigger = F.floor(since(F.col("ts")) * 5 / (since(F.lit(high)) + 1)).cast("int")
    arrived = arrived.withColumn("trigger", F.when(F.col("event_id") % 50 == 0, F.least(trigger + 1, F.lit(4)))
                                 .when(F.col("event_id") % 70 == 0, F.least(trigger + 3, F.lit(4))).otherwise(trigger))
    close = arrived.filter(F.col("ts") == F.lit(high)).limit(1).select((F.col("ts") + F.expr("interval 1 day")).alias("ts"), F.lit("none").alias("path"))
    schema = arrived.select("ts", "path").schema
    files = write_triggers(arrived, close, 5, f"{root}/staged", f"{root}/arrivals")
    stream = first_arrivals_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{root}/arrivals"))
    (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/ckpt")
        .trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    )
    return zoneless(spark.read.schema(stream.schema).parquet(f"{root}/out"))


# --- ledger, rollback, retention -------------------------------------------------------------

TIE = ["seq"]
NOW = "2024-01-31 00:00:00"


@query
def ledger_latest(spark, sf):
    return ledger.latest_status(shaped.as_ledger(spark, sf), TIE).select("job", "name", "status", "at", "row_count")


@query
def ledger_items(spark, sf):
    return ledger.batch_items(shaped.as_ledger(spark, sf), F.col("seq"))


@query
def ledger_stuck(spark, sf):
    rows = ledger.stuck(shaped.as_ledger(spark, sf), moment(NOW), tie=TIE)
    return rows.select("job", "name", "at")


@query
def ledger_watermark(spark, sf):
    return ledger.watermarks(shaped.as_ledger(spark, sf), F.col("seq")).select("job", "name", "watermark", "updated_at")


def all_work(spark, sf):
    name = F.concat(F.lit("b"), F.floor(F.col("event_id") / 3).cast("string"))
    return table(spark, sf, "events").select(F.lit("load").alias("job"), name.alias("name")).distinct()


@query
def work_list(spark, sf):
    return ledger.to_process(all_work(spark, sf), shaped.as_ledger(spark, sf), TIE)


@query
def startable_batches(spark, sf):
    return ledger.startable(all_work(spark, sf), shaped.as_ledger(spark, sf), TIE)


@query
def ledger_expiry(spark, sf):
    rows = ledger.unexpired(shaped.as_ledger(spark, sf), moment(NOW), days=10)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("entries"), F.min("at").alias("oldest"))


@query
def ledger_audit(spark, sf):
    return ledger.with_prefix(shaped.as_ledger(spark, sf), "batch#load#b12").select("name", "status", "at")


def loaded_orders(spark, sf):
    """Orders as a loaded table: a batch per month, loaded on the order date."""
    clean = shaped.normalised_orders(spark, sf)
    return clean.withColumns({
        "_batch_id": F.date_format("order_date", "yyyy-MM"),
        "_loaded_at": F.col("order_date").cast("timestamp_ntz"),
    })


@query
def rollback_by_batch(spark, sf):
    return merge.without_batch(loaded_orders(spark, sf), "1998-07")


@query
def rollback_delta(spark, sf):
    """The table now against the table as it was before the last changes."""
    clean, changes = orders_and_changes(spark, sf)
    return checksum.differing_rows(clean, merge.upsert(clean, changes, ORDER_KEYS), ORDER_KEYS, ORDERS.columns)


def stored_orders(spark, sf):
    """Orders as they were and as they are after the last changes, each stored with its digest tree."""
    clean, changes = orders_and_changes(spark, sf)
    root = scratch_dir(spark, "versions")
    sides = {"before": clean, "after": merge.upsert(clean, changes, ORDER_KEYS)}
    return [digest_tree.StoredVersion.store(df, f"{root}/{name}", ORDER_KEYS, ORDERS.columns, buckets=16) for name, df in sides.items()]


@query
def stored_version_delta(spark, sf):
    """Rows that differ between two stored versions; only differing leaves are opened."""
    return digest_tree.stored_delta(*stored_orders(spark, sf))[1]


@query
def stored_version_report(spark, sf):
    return digest_tree.stored_delta(*stored_orders(spark, sf))[0]


LATER = "2000-09-01"


@query
def digest_maintained(spark, sf):
    """The digests of a table after three loads, kept up by what each load added and replaced."""
    clean, changes = orders_and_changes(spark, sf)
    late = shaped.order_changes(clean, LATER).withColumn("order_priority", F.lit("9-LATE"))
    state, digests = clean.limit(0), None
    for batch in (clean, changes, late):
        delta = digest_tree.load_delta(state, batch, ORDER_KEYS, ORDERS.columns)
        digests = delta if digests is None else digest_tree.added_up((digests, 1), (delta, 1))
        state = merge.delete_insert(state, batch, ORDER_KEYS)
    return digests.groupBy(F.expr(f"leaf div {digest_tree.LEAVES}").cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("leaves"), F.sum("n").alias("n"),
        F.concat_ws("-", F.sum("lane0").cast("string"), F.sum("lane1").cast("string")).alias("checksum"))


@query
def digest_stale_leaves(spark, sf):
    """Leaves in which a target has drifted from the digests kept of its loads."""
    clean, damaged = orders_and_damaged(spark, sf, "scaled")
    kept, found = (digest_tree.tree(df, ORDER_KEYS, ORDERS.columns) for df in (clean, damaged))
    return digest_tree.differing_leaves(kept, found)


@query
def rollback_restore(spark, sf):
    """Load, change, restore the first version; then the same for a batch removed by its id."""
    clean, changes = orders_and_changes(spark, sf)
    schema = T.StructType([*ORDERS.target_schema().fields, T.StructField("_batch_id", T.StringType())])
    stored = VersionedTable(spark, scratch_dir(spark, "restore"), schema, ORDER_KEYS, 8)
    first = stored.upsert(clean.withColumn("_batch_id", F.lit("b1")), "b1")
    stored.upsert(changes.withColumn("_batch_id", F.lit("b2")), "b2")
    stored.restore(first, "undo-b2")
    return stored.read()


@query
def rollback_delete_batch(spark, sf):
    clean, changes = orders_and_changes(spark, sf)
    schema = T.StructType([*ORDERS.target_schema().fields, T.StructField("_batch_id", T.StringType())])
    stored = VersionedTable(spark, scratch_dir(spark, "delete-batch"), schema, ORDER_KEYS, 8)
    stored.upsert(clean.withColumn("_batch_id", F.lit("b1")), "b1")
    stored.upsert(changes.withColumn("_batch_id", F.lit("b2")), "b2")
    stored.upsert(changes.withColumn("_batch_id", F.lit("b2")), "b2")
    stored.delete_batch("b2", "undo-b2")
    return stored.read()


@query
def rollback_undo_batch(spark, sf):
    """Three loads; the second replaced rows of the first, and the third some of both. The second is taken back."""
    clean, changes = orders_and_changes(spark, sf)
    schema = T.StructType([*ORDERS.target_schema().fields, T.StructField("_batch_id", T.StringType())])
    stored = VersionedTable(spark, scratch_dir(spark, "undo-batch"), schema, ORDER_KEYS, 8)
    third = changes.filter("order_key % 3 = 0").withColumn("order_status", F.lit("T"))
    for name, rows in (("b1", clean), ("b2", changes), ("b3", third)):
        stored.upsert(rows.withColumn("_batch_id", F.lit(name)), name)
    stored.undo_batch("b2", "undo-b2")
    return stored.read()


@query
def retention_purge(spark, sf):
    return merge.retained(loaded_orders(spark, sf), date(2001, 8, 1))


@query
def retention_purge_rewrite(spark, sf):
    """The purge as a rewrite of a stored table: only the years that hold old rows are touched."""
    path = scratch_dir(spark, "purge")
    loaded_orders(spark, sf).withColumn("year", F.year("order_date")).write.partitionBy("year").parquet(path)
    sink_files.purge_partitions(spark, path, "year", F.col("_loaded_at") >= F.date_add(F.lit(date(2001, 8, 1)), -730))
    return spark.read.parquet(path).drop("year")


@query
def ledger_compaction(spark, sf):
    """A ledger of many files, compacted without batch entries older than ten days."""
    stored = Ledger(spark, scratch_dir(spark, "compaction"))
    shaped.as_ledger(spark, sf).withColumn("at", F.col("at").cast("timestamp")).repartition(20).write.json(f"{stored.path}/first")
    stored.compact(datetime.fromisoformat(NOW).replace(tzinfo=timezone.utc), days=10)
    kept = stored.entries().groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("newest"))
    return kept.withColumn("files", F.lit(len(stored.entries().inputFiles())))


@query
def batch_scoped_count(spark, sf):
    scoped = reconcile.loaded_since(loaded_orders(spark, sf), moment("1998-06-30 12:00:00"))
    return scoped.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n"))


# --- gates, alarms, roll-ups -----------------------------------------------------------------


def nights(spark, sf):
    """Event types as tables, days as nights; green while few values are high."""
    share = F.avg(F.when(F.col("value") > 100, 1.0).otherwise(0.0))
    return table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        (share < 0.15).alias("green")
    )


@query
def green_streaks(spark, sf):
    return monitor.green_streaks(nights(spark, sf), "event_type", "day", "green")


@query
def green_streak_gate(spark, sf):
    return monitor.streak_gate(nights(spark, sf), "event_type", "day", "green", needed=3)


@query
def stability_gate(spark, sf):
    return monitor.streak_gate(nights(spark, sf), "event_type", "day", "green", needed=monitor.STABLE_DAYS)


@query
def diff_rate_gate(spark, sf):
    rates = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("value") > 250).alias("mismatches")
    )
    return monitor.diff_rate_gate(rates, "event_type", "day", "requests", "mismatches", limit_pct=1.5)


@query
def lag_alarm(spark, sf):
    rows = monitor.consecutive_breaches(
        table(spark, sf, "events"), "ts", ["event_type"], "value", limit=50.0, seconds=3600
    )
    return rows.select("event_type", "period_start", F.round("measure", 4).alias("measure"))


@query
def drift_alarm(spark, sf):
    drift = table(spark, sf, "events").withColumn("drift_pct", F.col("value") / 100)
    return monitor.drift_alarm(drift, "ts", ["event_type"], "drift_pct")


@query
def failure_alarm(spark, sf):
    return monitor.failure_alarm(table(spark, sf, "events"), "ts", [], F.col("event_type") == "error")


@query
def rows_per_hour(spark, sf):
    return monitor.rows_per_hour(table(spark, sf, "events"), "ts", ["event_type"], F.floor("value"))


@query
def throughput_trend(spark, sf):
    started = F.col("ts") - F.make_dt_interval(secs=F.floor(F.col("value")).cast("decimal(18,6)"))
    table_runs = table(spark, sf, "events").select(
        F.col("event_type").alias("job"), started.alias("started_at"), F.col("ts").alias("completed_at"),
        (F.col("event_id") % 1000).alias("row_count"),
    )
    return monitor.throughput_trend(table_runs)


@query
def latest_run_gate(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("chain_id"), F.date_format("ts", "yyyyMMdd").alias("run_date"),
        F.date_format("ts", "HHmmss").alias("run_time"), "event_id",
        F.when(F.col("value") < 60, "G").otherwise("R").alias("status"),
    )
    newest = monitor.latest_run(events, "purchase", ["run_date", "run_time"])
    return newest.withColumn("may_extract", F.col("status") == "G")


# --- sources and sinks -----------------------------------------------------------------------


@query
def incremental_scan(spark, sf):
    return incremental.newer_than(table(spark, sf, "orders"), "o_orderdate", moment("2000-12-31 00:00:00"))


@query
def advance_watermark(spark, sf):
    """Rows and highest watermark, both seen while the batch is written."""
    path = scratch_dir(spark, "watermark")
    written = sink_files.write_batch(table(spark, sf, "orders"), path, "o_orderdate")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read")).select(
        "rows_read", F.lit(written.rows).cast("bigint").alias("rows_written"),
        F.lit(written.watermark).cast("timestamp_ntz").alias("watermark"),
    )


@query
def consumed_requests(spark, sf):
    """Queue rows of requests not taken yet; an order's month is its request."""
    queue = table(spark, sf, "orders").withColumn("request", F.date_format("o_orderdate", "yyyyMM"))
    consumed = table(spark, sf, "lineitem").filter("l_shipdate < '1997-01-01'").select(
        F.date_format("l_shipdate", "yyyyMM").alias("request")
    )
    return ledger.unconsumed(queue, consumed, "request")


@query
def queue_loads(spark, sf):
    """A queue of orders by their number, loaded by a pointer: half of it, then the rest with a crash on the way; who loaded what."""
    root = scratch_dir(spark, "queue")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    middle = orders.agg(F.expr("cast(avg(o_orderkey) as bigint)")).first()[0]
    reader = QueueReader(spark, root, "o_orderkey")

    def dies(rows, folder):
        rows.limit(100).write.mode("overwrite").parquet(folder)
        raise RuntimeError("lost")

    reader.consume(orders.filter(F.col("o_orderkey") <= middle))
    try:
        reader.consume(orders.filter(F.col("o_orderkey") <= 2 * middle), write=dies)
    except RuntimeError:
        pass
    # More requests have come meanwhile; the load that was cut short reads what it had set out to read.
    while reader.consume(orders):
        pass
    return reader.loaded(orders.schema)


@query
def parquet_scan(spark, sf):
    path = scratch_dir(spark, "scan")
    sink_files.write_batch(table(spark, sf, "part"), path)
    return files.batch(spark, path)


@query
def csv_scan(spark, sf):
    path = scratch_dir(spark, "csv")
    files.write_csv_extract(shaped.materials(spark, sf), path)
    return files.csv_extract(spark, path, MATERIAL)


@query
def staging_zone(spark, sf):
    path = scratch_dir(spark, "staging")
    sink_files.write_batch(vendors(spark, sf), path)
    return files.batch(spark, path)


@query
def sidecars(spark, sf):
    root = scratch_dir(spark, "sidecars")
    sink_files.write_extract(shaped.materials(spark, sf), MATERIAL, root, RUN_AT)
    declared = spark.read.text(f"{root}/_schema").select(
        F.json_array_length(F.get_json_object("value", "$.fields")).alias("n_columns"),
    )
    stored = spark.read.json(f"{root}/_manifest").select(
        "contract_fqn", "load_strategy", "partition_column",
        F.col("partition_num_chunks").cast("int").alias("partition_num_chunks"),
        F.col("row_count").cast("bigint").alias("row_count"), "extracted_at",
    )
    n = declared.first()["n_columns"]
    return stored.withColumn("n_columns", F.lit(n))


@query
def hour_partition_layout(spark, sf):
    path = scratch_dir(spark, "hourly")
    sink_files.write_hourly(shaped.change_feed(spark, sf), "_dms_committed_at", path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("dt").cast("string").alias("dt"), F.col("hh").cast("int").alias("hh")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def keyed_layout(spark, sf):
    path = scratch_dir(spark, "keyed")
    sink_files.write_keyed(materials(spark, sf), MATERIAL, path, partitions=4)
    return spark.read.parquet(path)


@query
def clustered_layout(spark, sf):
    """Loaded orders clustered by key and load time: per year, what is in the files whose ranges meet it, and whether they overlap."""
    path = scratch_dir(spark, "clustered")
    columns = ["order_key", "_loaded_at"]
    clustered.write_clustered(loaded_orders(spark, sf), columns, path, files=16)
    ranges = clustered.file_ranges(spark, path, columns)
    stored = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    years = stored.select(F.year("_loaded_at").alias("year")).distinct()
    met = ranges.join(years, F.col("year").between(F.year("least__loaded_at"), F.year("greatest__loaded_at"))).select("year", "file")
    held = stored.withColumn("year", F.year("_loaded_at")).join(met, ["year", "file"])
    clash = clustered.overlaps(ranges).agg(F.count(F.lit(1)).alias("overlapping_files"))
    sums = held.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("total_price").alias("total"), F.max("order_key").alias("last_key"))
    return sums.join(clash)


def database(spark) -> jdbc.Database:
    """The session's database, or an in-memory one where driver and executors share a JVM."""
    url = spark.conf.get("spark.plumbline.jdbc.url", None)
    if url:
        return jdbc.Database(url)
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.plumbline.jdbc.url to a database all executors can reach")
    return jdbc.derby("plumbline")


def stored_suppliers(spark, sf, name):
    db = database(spark)
    sink_jdbc.write_table(table(spark, sf, "supplier"), db, name)
    return db


def lower_names(df):
    """Column names as in the Parquet table, whatever case the database gives back."""
    return df.toDF(*[c.lower() for c in df.columns])


@query
def jdbc_range_scan(spark, sf):
    db = stored_suppliers(spark, sf, "sup_range")
    return lower_names(jdbc.scan(spark, db, "sup_range", "s_suppkey", 4))


@query
def jdbc_hash_scan(spark, sf):
    db = stored_suppliers(spark, sf, "sup_hash")
    return lower_names(jdbc.hash_scan(spark, db, "sup_hash", "s_suppkey", 4))


@query
def jdbc_key_range_scan(spark, sf):
    db = stored_suppliers(spark, sf, "sup_keys")
    return lower_names(jdbc.scan(spark, db, "sup_keys", "s_name", 4))


@query
def jdbc_queue_scan(spark, sf):
    """Orders as a request queue: the customer is the request; requests already taken are left out."""
    db = database(spark)
    sink_jdbc.write_table(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), db, "queue")
    queue = lower_names(jdbc.queue_scan(spark, db, "queue", 4, "o_custkey"))
    taken = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return ledger.unconsumed(queue, taken, "o_custkey")


@query
def jdbc_even_scan(spark, sf):
    """Orders by a key that few customers hold most of: slices of about as many rows, a customer who fills several split by order."""
    db = database(spark)
    skewed = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderkey") % 3 == 0, 7).when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey") * F.col("o_custkey")).cast("bigint").alias("o_custkey"))
    sink_jdbc.write_table(skewed, db, "orders_even")
    by_key = lower_names(jdbc.even_scan(spark, db, "orders_even", "o_custkey", 8, split_by="o_orderkey"))
    by_day = lower_names(jdbc.even_scan(spark, db, "orders_even", "o_orderdate", 8, f"{db.name('o_custkey')} > 7"))
    return by_key.withColumn("cut_by", F.lit("key")).unionByName(by_day.withColumn("cut_by", F.lit("day")))


@query
def jdbc_single_scan(spark, sf):
    db = stored_suppliers(spark, sf, "sup_single")
    return lower_names(jdbc.scan(spark, db, "sup_single", None, 4, f"{db.name('s_nationkey')} > 10"))


@query
def jdbc_bounds(spark, sf):
    db = stored_suppliers(spark, sf, "sup_bounds")
    low, high = jdbc.bounds(spark, db, "sup_bounds", "s_suppkey")
    return table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high")
    )


@query
def jdbc_upsert(spark, sf):
    """Load suppliers, then upsert a delta with a changed nation and new keys."""
    db = stored_suppliers(spark, sf, "sup_upsert")
    supplier = table(spark, sf, "supplier")
    changed = supplier.filter("s_nationkey = 3").withColumn("s_nationkey", F.lit(99))
    new = supplier.withColumn("s_suppkey", -F.col("s_suppkey") - 1)
    sink_jdbc.upsert_table(changed.unionByName(new), db, "sup_upsert", ["s_suppkey"])
    return lower_names(jdbc.scan(spark, db, "sup_upsert", "s_suppkey", 4))


# --- whole runs ------------------------------------------------------------------------------


@query
def run_table(spark, sf):
    """One table end to end, run twice under one batch id; the operational target."""
    run = runs.Run(spark, scratch_dir(spark, "run"), buckets=4)
    raw = shaped.materials(spark, sf)
    for _ in range(2):
        runs.run_table(run, MATERIAL, BATCH, lambda mark: incremental.newer_than(raw, "LAEDA", mark), RUN_AT)
    return run.target(MATERIAL, "operational").read().select(*MATERIAL.columns)


@query
def run_table_late_rows(spark, sf):
    """Two loads: of the watermark's day, all rows but one come after the first; the operational target."""
    run = runs.Run(spark, scratch_dir(spark, "late"), buckets=4)
    raw = shaped.materials(spark, sf)
    day = raw.where("LAEDA is not null").groupBy("LAEDA").agg(F.count("*").alias("n"), F.min("MATNR").alias("known")).orderBy(F.desc("n"), "LAEDA").first()
    first = raw.filter((F.col("LAEDA") < day["LAEDA"]) | (F.col("LAEDA") == day["LAEDA"]) & (F.col("MATNR") == day["known"]) | F.col("LAEDA").isNull())
    for batch_id, rows in ((BATCH, first), (f"{BATCH}-2", raw)):
        runs.run_table(run, MATERIAL, batch_id, lambda mark, rows=rows: incremental.newer_than(rows, "LAEDA", mark), RUN_AT)
    return run.target(MATERIAL, "operational").read().select(*MATERIAL.columns)


@query
def run_table_bad_values(spark, sf):
    """A table with unreadable weights and unknown flags: what the run reports, and that it loads nothing."""
    run = runs.Run(spark, scratch_dir(spark, "bad"), buckets=4)
    weight = F.when(F.col("MATNR").cast("bigint") % 5 == 0, "heavy").otherwise(F.col("BRGEW"))
    flag = F.when(F.col("MATNR").cast("bigint") % 7 == 0, "Z").otherwise(F.col("LVORM"))
    raw = shaped.materials(spark, sf).withColumns({"BRGEW": weight, "LVORM": flag})
    outcome = runs.run_table(run, MATERIAL, BATCH, lambda mark: raw, RUN_AT)
    loaded = run.target(MATERIAL, "operational").read().count()
    found = spark.read.json(f"{run.report(MATERIAL, BATCH)}/coercion")
    return found.select(
        F.get_json_object("evidence", "$.column_name").alias("column_name"), "status",
        F.get_json_object("evidence", "$.lost_count").cast("bigint").alias("lost_count"),
        F.lit(outcome.status).alias("outcome"), F.lit(loaded).cast("bigint").alias("loaded"))


@query
def run_rollback(spark, sf):
    """Load, load a second batch, take it back, load it again: the rows, and what the ledger says."""
    run = runs.Run(spark, scratch_dir(spark, "rollback"), buckets=4)
    raw = shaped.vendors(spark, sf)
    early = F.col("LIFNR").cast("bigint") % 2 == 0
    runs.run_table(run, VENDOR, "first", lambda mark: raw.filter(early), RUN_AT)
    runs.run_table(run, VENDOR, "second", lambda mark: raw.filter(~early), RUN_AT)
    runs.roll_back(run, VENDOR, "second")
    between = run.target(VENDOR, "operational").read().count()
    runs.run_table(run, VENDOR, "second", lambda mark: raw.filter(~early), RUN_AT)
    status = ledger.latest_status(run.ledger.entries(), TIE).select(F.col("name").alias("_batch_id"), "status")
    rows = run.target(VENDOR, "operational").read().groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(status, "_batch_id").select(
        F.col("_batch_id").alias("batch_id"), "n_rows", "status", F.lit(between).cast("bigint").alias("between"))


@query
def cdc_new_checkpoint(spark, sf):
    """The feed in two halves, each merged under a checkpoint of its own."""
    root = scratch_dir(spark, "cdc-again")
    schema = cdc.feed_schema(ACTIVITY, STORED)
    silver = VersionedTable(spark, f"{root}/silver", cdc.silver_schema(ACTIVITY), ["user_id"], 4)
    for i, part in enumerate(half_feeds(spark, sf)):
        stored = part.withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp"))
        stored.write.mode("append").parquet(f"{root}/feed")
        cdc.ingest_bronze(spark, f"{root}/feed", f"{root}/bronze", f"{root}/ckpt", schema).awaitTermination()
        cdc.merge_silver(spark, f"{root}/bronze", silver, f"{root}/ckpt{i}", ACTIVITY, cdc.bronze_schema(schema)).awaitTermination()
    return zoneless(merge.current_rows(silver.read()))


@query
def run_table_masked(spark, sf):
    run = runs.Run(spark, scratch_dir(spark, "run"), buckets=4)
    runs.run_table(run, CUSTOMER, BATCH, lambda mark: shaped.customers(spark, sf), RUN_AT)
    return run.target(CUSTOMER, "analytical").read().select(*CUSTOMER.columns)


@query
def run_many(spark, sf):
    """Three tables at once; rows per target and the outcome in the ledger."""
    run = runs.Run(spark, scratch_dir(spark, "many"), buckets=4)
    work = []
    for name in ("MARA", "KNA1", "LFA1"):
        df, contract = shaped.extract(spark, sf, name)
        work.append((contract, f"{BATCH}-{name}", lambda mark, df=df: df))
    runs.run_many(run, work)
    counts = None
    for contract, batch_id, _ in work:
        rows = run.target(contract, "operational").read().groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
        counts = rows if counts is None else counts.unionByName(rows)
    status = ledger.latest_status(run.ledger.entries()).select(F.col("name").alias("_batch_id"), "status", "row_count")
    return counts.join(status, "_batch_id").select(F.col("_batch_id").alias("batch_id"), "n_rows", "status", "row_count")


@query
def run_many_ordered(spark, sf):
    """Four tables of which some need others: the vendors fail first, and hold back two; then all are loaded."""
    run = runs.Run(spark, scratch_dir(spark, "ordered"), buckets=4)
    work = []
    for name in ("ZPRICE_HISTORY", "MARA", "KNA1", "LFA1"):
        df, contract = shaped.extract(spark, sf, name)
        work.append((contract, f"{BATCH}-{name}", lambda mark, df=df: df))
    needs = {"ZPRICE_HISTORY": ["MARA"], "MARA": ["LFA1"]}
    contract, batch_id, vendors_of = work[3]
    twice = (contract, batch_id, lambda mark: vendors_of(mark).unionByName(vendors_of(mark)))
    rows = []
    for attempt, tables in ((1, [*work[:3], twice]), (2, work)):
        for o in runs.run_many(run, tables, needs):
            rows.append((attempt, o.table, o.status, o.rows))
    return spark.createDataFrame(rows, "attempt int, table_name string, status string, n_rows long")


@query
def run_reports(spark, sf):
    """The stored reports of one run: three phases of five layers."""
    run = runs.Run(spark, scratch_dir(spark, "reports"), buckets=4)
    runs.run_table(run, VENDOR, BATCH, lambda mark: shaped.vendors(spark, sf), RUN_AT)
    return spark.read.json(f"{run.report(VENDOR, BATCH)}/*").select("phase", "layer", "status")


@query
def phase_gates(spark, sf):
    """Streak, difference-rate and prerequisite gates of one table, together."""
    streak = green_streak_gate(spark, sf).select("table_name", F.lit("green_nights").alias("gate"), "gate_open")
    rate = diff_rate_gate(spark, sf).select("table_name", F.lit("diff_rate").alias("gate"), "gate_open")
    stable = stability_gate(spark, sf).select("table_name", F.lit("stable_days").alias("gate"), "gate_open")
    # A table that needs another one waits until that one has had a green night.
    needs = table(spark, sf, "events").select(F.col("event_type").alias("table_name"), F.col("event_type").alias("needed")).distinct().withColumn(
        "needed", F.when(F.col("table_name") == "purchase", "signup").when(F.col("table_name") == "click", "view"))
    ready = nights(spark, sf).filter("green").select(F.col("event_type").alias("needed")).distinct()
    waiting = parity.missing_prerequisites(needs.filter("needed is not null"), ready, ["needed"]).select("table_name")
    prerequisites = needs.join(waiting.withColumn("_waits", F.lit(True)), "table_name", "left").select(
        "table_name", F.lit("prerequisites").alias("gate"), F.col("_waits").isNull().alias("gate_open"))
    return streak.unionByName(rate).unionByName(stable).unionByName(prerequisites)
