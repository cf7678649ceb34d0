import json
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, final_plan_of, plan_of
from plumbline.mdm import CUSTOMER, MATERIAL, ORDERS
from plumbline.operators import incremental, parity, reconcile
from plumbline.operators.checksum import checksum_bands, differing_rows, drill_down, exact_difference
from plumbline.operators.transform import mask_personal, normalise
from plumbline.sources import shaped

KEYS = ["order_key"]


def statuses(rows):
    return {r["layer"]: r["status"] for r in rows.collect()}


@pytest.fixture(scope="module")
def clean(spark):
    return shaped.normalised_orders(spark, SMALL)


@pytest.mark.parametrize("kind, failing", [
    ("dropped", {"row_count", "checksum_bands", "statistical_distribution"}),
    ("nulled", {"null_ratio", "checksum_bands"}),
    ("duplicated", {"row_count", "pk_uniqueness", "checksum_bands"}),
    ("scaled", {"checksum_bands", "statistical_distribution"}),
    ("swapped", {"checksum_bands"}),
])
def test_each_fault_fails_its_layers(clean, kind, failing):
    found = statuses(reconcile.layer_rows(clean, shaped.damaged_orders(clean, kind), ORDERS))
    assert set(found) == set(reconcile.LAYERS)
    assert {k for k, v in found.items() if v != "PASSED"} == failing
    assert found["null_ratio"] == ("WARNING" if kind == "nulled" else "PASSED")


def test_equal_tables_pass(clean):
    rows = reconcile.reconcile(clean, clean.repartition(5), ORDERS, "b")
    assert set(statuses(rows).values()) == {"PASSED"}
    assert {r["evidence"] for r in rows.filter("layer <> 'row_count'").collect()} == {None}


def text_rows(spark, keys):
    columns = MATERIAL.columns
    return spark.createDataFrame([(k, *["X"] * (len(columns) - 1)) for k in keys], ", ".join(f"{c} string" for c in columns))


def test_count_evidence(spark):
    source, target = text_rows(spark, [f"M{i}" for i in range(100)]), text_rows(spark, [f"M{i}" for i in range(90)])
    row = reconcile.layer_rows(source, target, MATERIAL).filter("layer = 'row_count'").first()
    assert row["status"] == "FAILED" and row["message"] == "source=100 target=90 diff=10.000%"
    evidence = json.loads(row["evidence"])
    assert (evidence["source_count"], evidence["target_count"]) == (100, 90)
    tolerant = MATERIAL.with_tolerances(count_tolerance_pct=10.0)
    assert statuses(reconcile.layer_rows(source, target, tolerant))["row_count"] == "PASSED"


def test_duplicate_evidence(spark):
    target = text_rows(spark, ["M1", "M1", *[f"M{i}" for i in range(2, 11)]])
    row = reconcile.layer_rows(target, target, MATERIAL).filter("layer = 'pk_uniqueness'").first()
    evidence = json.loads(row["evidence"])
    assert row["status"] == "FAILED" and evidence["duplicate_count"] == 1
    assert evidence["sample_duplicates"] == [{"material_number": "M1", "count": 2}]


def test_empty_sides(spark, clean):
    none = clean.limit(0)
    found = statuses(reconcile.layer_rows(none, clean, ORDERS))
    assert found["row_count"] == "WARNING" and found["checksum_bands"] == "FAILED"
    # A source sum of nothing against a target sum of something is a drift.
    assert found["statistical_distribution"] == "FAILED"
    found = statuses(reconcile.layer_rows(none, none, ORDERS))
    assert found["row_count"] == "WARNING" and found["checksum_bands"] == "PASSED"


def test_no_keys_is_a_warning(clean):
    keyless = replace(ORDERS, keys=())
    found = statuses(reconcile.layer_rows(clean, clean, keyless))
    assert found["pk_uniqueness"] == found["checksum_bands"] == "WARNING"


def test_missing_columns_fail(clean):
    found = statuses(reconcile.layer_rows(clean, clean.drop("order_key"), ORDERS))
    assert found["pk_uniqueness"] == found["checksum_bands"] == "FAILED"
    assert found["row_count"] == found["null_ratio"] == "PASSED"


def test_null_drift_counts_columns(spark):
    source = text_rows(spark, ["M1", "M2"])
    lost = source.withColumns({c: F.lit(None).cast("string") for c in ("created_by", "material_type")})
    assert statuses(reconcile.layer_rows(source, lost, MATERIAL))["null_ratio"] == "WARNING"
    lost = lost.withColumn("material_group", F.lit(None).cast("string"))
    assert statuses(reconcile.layer_rows(source, lost, MATERIAL))["null_ratio"] == "FAILED"


def test_header(clean):
    rows = reconcile.layer_rows(clean, shaped.damaged_orders(clean, "nulled"), ORDERS)
    header = reconcile.report_header(rows, ORDERS, "b7").first()
    assert header["overall_status"] == "FAILED" and header["batch_id"] == "b7"
    assert [r["layer"] for r in header["results"]] == list(reconcile.LAYERS)
    assert header["source_row_count"] == header["target_row_count"] == clean.count()
    only_warning = rows.filter("layer = 'null_ratio'")
    assert reconcile.overall(only_warning).first()[0] == "WARNING"
    assert reconcile.overall(only_warning, warnings_count=False).first()[0] == "PASSED"


def test_row_text_has_no_collisions(spark):
    pairs = [(("a|b", "c"), ("a", "b|c")), ((None, "a"), ("a", None)), (("~", None), (None, "~")), (("", None), (None, ""))]
    for left, right in pairs:
        a = spark.createDataFrame([(1, *left)], "k int, x string, y string")
        b = spark.createDataFrame([(1, *right)], "k int, x string, y string")
        assert checksum_bands(a, b, ["k"], ["k", "x", "y"]).filter("differs").count() == 1, (left, right)


def test_checksum_sees_repeated_rows(spark):
    a = spark.createDataFrame([(1, "x")], "k int, x string")
    three = a.union(a).union(a)
    assert checksum_bands(a, three, ["k"], ["k", "x"]).filter("differs").count() == 1


def test_drill_down_agrees_with_full_comparison(clean):
    damaged = shaped.damaged_orders(clean, "dropped", "nulled", "duplicated", "scaled", "swapped")
    found = drill_down(clean, damaged, KEYS, ORDERS.columns)
    everything = differing_rows(clean, damaged, KEYS, ORDERS.columns)
    assert found.exceptAll(everything).count() == everything.exceptAll(found).count() == 0
    keys = exact_difference(clean, damaged).select("order_key").distinct()
    assert found.select("order_key").exceptAll(keys).count() == keys.exceptAll(found.select("order_key")).count() == 0
    assert set(r[0] for r in found.select("reason").distinct().collect()) == {
        "missing_in_target", "count_differs", "values_differ",
    }


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows under one key: row comparison still shuffles one row per task and key."""
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) as k", "cast(id % 10 as string) as x")
    found = differing_rows(hot, hot.filter("k <> 7 or x <> '3'"), ["k"], ["k", "x"])
    plan = plan_of(found)
    assert "Join" not in plan and plan.index("partial_sum") > plan.index("Exchange")
    rows = {r["k"]: r for r in found.collect()}
    assert rows[7]["reason"] == "count_differs" and rows[7]["source_count"] - rows[7]["target_count"] > 900
    assert set(rows) == {7}


def test_one_scan_per_side(clean):
    """The report shuffles at most a row per bucket and task, and keys once."""
    plan = final_plan_of(reconcile.layer_rows(clean, clean.filter("order_key > 5"), ORDERS))
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_window_layers(clean):
    window = (date(1996, 1, 1), date(1999, 12, 31))
    same = statuses(incremental.window_report(clean, clean, ORDERS, *window))
    assert set(same.values()) == {"PASSED"} and len(same) == 3
    missing = clean.filter("order_key % 10 <> 0")
    found = statuses(incremental.window_report(missing, clean, ORDERS, *window))
    assert found["row_count_window"] == "FAILED" and found["pk_spot_check"] == "FAILED"
    nothing = statuses(incremental.window_report(clean, clean, ORDERS, date(1900, 1, 1), date(1900, 1, 2)))
    assert set(nothing.values()) == {"PASSED"}


def test_window_is_half_open_and_pushed_down(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    days = [r[0] for r in orders.select("o_orderdate").distinct().orderBy("o_orderdate").limit(3).collect()]
    lo, hi = (F.lit(d.isoformat(" ")).cast("timestamp_ntz") for d in (days[0], days[2]))
    inside = incremental.in_window(orders, "o_orderdate", lo, hi)
    assert {r[0] for r in inside.select("o_orderdate").distinct().collect()} == set(days[1:])
    plan = plan_of(inside.select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_spot_check_is_repeatable(clean):
    first = incremental.sampled_keys(clean, KEYS, seed=3).collect()
    assert len(first) == 50 and first == incremental.sampled_keys(clean.repartition(7), KEYS, seed=3).collect()
    assert first != incremental.sampled_keys(clean, KEYS, seed=4).collect()


def test_three_way(spark):
    raw = normalise(shaped.customers(spark, SMALL), CUSTOMER)
    same = parity.three_way(raw, raw, mask_personal(raw, CUSTOMER), CUSTOMER)
    assert {r["status"] for r in same.collect()} == {"PASSED"}
    unmasked = parity.comparison_statuses(parity.three_way(raw, raw, raw, CUSTOMER))
    assert {r["comparison"]: r["status"] for r in unmasked.collect()} == {
        "raw_vs_operational": "PASSED", "raw_vs_analytical": "FAILED", "operational_vs_analytical": "FAILED",
    }


def test_shadow_differences(spark):
    schema = "day string, request int, answer string"
    old = spark.createDataFrame([("d", 1, "a"), ("d", 2, "b"), ("d", 3, "c"), ("d", 5, None)], schema)
    new = spark.createDataFrame([("d", 1, "a"), ("d", 2, "x"), ("d", 4, "c"), ("d", 5, None)], schema)
    found = parity.shadow_differences(old, new, ["day", "request"], ["answer"])
    assert {r["request"]: r["mismatch"] for r in found.collect()} == {1: False, 2: True, 3: True, 4: True, 5: False}
    assert parity.mismatch_rate(found, "day").first()["mismatch_pct"] == 60.0


def test_loaded_since(spark):
    df = spark.sql("select timestamp'2026-01-01' as _loaded_at union all select timestamp'2026-01-03'")
    assert reconcile.loaded_since(df, F.expr("timestamp'2026-01-02'")).count() == 1


@pytest.mark.parametrize("change", ["v + 7e-13", "if(k = 3, 9e25D, v)", "if(k = 4, cast('NaN' as double), v)"])
def test_small_large_and_no_numbers_are_seen(spark, change):
    from plumbline.operators.checksum import checksum_bands, differing_rows

    source = spark.range(20).selectExpr("id as k", "if(id = 3, 1e25D, id * 1e-12) as v")
    target = source.selectExpr("k", f"{change} as v")
    assert checksum_bands(source, target, ["k"], ["k", "v"]).filter("differs").count() > 0
    assert {r["columns"] for r in differing_rows(source, target, ["k"], ["k", "v"]).collect()} == {"v"}
    assert checksum_bands(source, source, ["k"], ["k", "v"]).filter("differs").count() == 0
