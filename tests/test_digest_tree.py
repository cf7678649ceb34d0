import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from plumbline.mdm import ORDERS
from plumbline.operators import digest_tree, merge
from plumbline.operators.digest_tree import StoredVersion, added_up, differing_leaves, load_delta, stored_delta, tree
from plumbline.sources import shaped

KEYS = ["order_key"]


@pytest.fixture(scope="module")
def clean(spark):
    return shaped.normalised_orders(spark, SMALL)


def rows_of(digests):
    return {tuple(r) for r in digests.collect()}


def test_maintained_lanes_equal_recomputed_ones(spark, clean):
    state, digests = clean.limit(0), None
    loads = [clean.filter("order_key % 3 <> 0"), clean.filter("order_key % 2 = 0").withColumn("order_status", F.lit("Z")),
             shaped.order_changes(clean, "1998-01-01"), clean.limit(0)]
    for batch in loads:
        delta = load_delta(state, batch, KEYS, ORDERS.columns)
        digests = delta if digests is None else added_up((digests, 1), (delta, 1))
        state = merge.delete_insert(state, batch, KEYS)
        assert rows_of(digests) == rows_of(tree(state, KEYS, ORDERS.columns))
    # What is taken away again leaves nothing behind.
    assert rows_of(added_up((digests, 1), (tree(state, KEYS, ORDERS.columns), -1))) == set()


def test_keys_of_null_are_replaced(spark):
    table = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    batch = spark.createDataFrame([(None, "c")], "k int, v string")
    after = merge.delete_insert(table, batch, ["k"])
    kept = added_up((tree(table, ["k"], ["k", "v"]), 1), (load_delta(table, batch, ["k"], ["k", "v"]), 1))
    assert rows_of(kept) == rows_of(tree(after, ["k"], ["k", "v"]))


def test_a_hot_leaf_is_one_row_of_each_task(clean):
    hot = clean.withColumn("order_key", F.lit(7))
    assert tree(hot, KEYS, ORDERS.columns).count() == 1
    assert "partial_sum" in plan_of(tree(hot, KEYS, ORDERS.columns))


def test_only_differing_leaves_are_opened(spark, clean, folder):
    changed = clean.withColumn("order_status", F.when(F.col("order_key").isin(1, 2, 3), "Z").otherwise(F.col("order_status"))).filter("order_key <> 5")
    left, right = (StoredVersion.store(df, f"{folder}/{n}", KEYS, ORDERS.columns, 16, 8) for n, df in (("a", clean), ("b", changed)))
    report, rows = stored_delta(left, right)
    found = {(r["order_key"], r["reason"], r["columns"]) for r in rows.collect()}
    assert found == {(k, "values_differ", "order_status") for k in (1, 2, 3)} | {(5, "missing_in_target", None)}
    row = report.first()
    assert (row["left_rows"], row["right_rows"], row["changed"], row["missing_right"], row["missing_left"], row["status"]) == (
        clean.count(), clean.count() - 1, 3, 1, 0, "FAILED") and 1 <= row["differing_leaves"] <= 4
    scans = [line for line in plan_of(rows).split("\n") if "FileScan parquet" in line]
    assert len(scans) >= 2 and all("PartitionFilters: [_bucket" in s and "In(_leaf" in s for s in scans)
    # Those leaves hold few rows, and whole files are left out.
    only = [r["leaf"] for r in differing_leaves(left.tree(), right.tree()).collect()]
    opened = left.rows(only, 8)
    assert opened.count() < clean.count() / 10 and set(opened.inputFiles()) <= set(left.rows().inputFiles())


def test_equal_versions(spark, clean, folder):
    left, right = (StoredVersion.store(df, f"{folder}/{n}", KEYS, ORDERS.columns, 4, 4) for n, df in (("a", clean), ("b", clean.repartition(3))))
    report, rows = stored_delta(left, right)
    assert rows.count() == 0 and report.first()["status"] == "PASSED" and report.first()["differing_leaves"] == 0
    assert rows_of(left.tree()) == rows_of(tree(clean, KEYS, ORDERS.columns, 4, 4))
    other = StoredVersion.store(clean, f"{folder}/c", KEYS, ORDERS.columns, 4, 8)
    with pytest.raises(ValueError):
        stored_delta(left, other)


def test_leaves_of_a_bucket_follow_each_other(clean):
    placed = clean.select(digest_tree.key_leaf(clean, KEYS, 16, 8).alias("leaf"), digest_tree.key_bucket(clean, KEYS, 16).alias("b"))
    assert placed.filter("leaf div 8 <> b").count() == 0 and placed.select("leaf").distinct().count() == 128
