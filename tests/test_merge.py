import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL, plan_of
from plumbline.operators import merge
from plumbline.sinks.versioned import VersionedTable
from plumbline.sources import shaped
from plumbline.streaming.cdc import ORDER

SCHEMA = "k long, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], SCHEMA)


@pytest.fixture(scope="module")
def changes(spark):
    return spark.createDataFrame([(2, "B"), (4, "D")], SCHEMA)


def test_upsert(target, changes):
    assert rows(merge.upsert(target, changes, ["k"])) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_upsert_reduces_to_the_last_change(spark, target):
    twice = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], SCHEMA + ", rev int")
    assert rows(merge.upsert(target, twice, ["k"], order=["rev"])) == [(1, "a"), (2, "y"), (3, "c")]


def test_upsert_of_keys_alone(spark):
    keys = spark.createDataFrame([(1,), (2,)], "k long")
    assert rows(merge.upsert(keys, spark.createDataFrame([(2,), (3,), (3,)], "k long"), ["k"])) == [(1,), (2,), (3,)]


def test_delete_insert(target, changes):
    assert rows(merge.delete_insert(target, changes, ["k"])) == rows(merge.upsert(target, changes, ["k"]))
    assert merge.delete_insert(target, changes, []).count() == 5
    assert rows(merge.delete_using(target, changes, ["k"])) == [(1, "a"), (3, "c")]


def test_upsert_twice_is_upsert_once(target, changes):
    once = merge.upsert(target, changes, ["k"])
    assert rows(merge.upsert(once, changes, ["k"])) == rows(once)


def test_merge_matched(target, changes):
    assert rows(merge.merge_matched(target, changes, ["k"])) == [
        (1, "a", "kept"), (2, "B", "updated"), (3, "c", "kept"), (4, "D", "inserted"),
    ]


def test_matched_change_to_null_is_kept(spark, target):
    nulled = spark.createDataFrame([(2, None)], SCHEMA)
    assert (2, None, "updated") in [tuple(r) for r in merge.merge_matched(target, nulled, ["k"]).collect()]


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    plan = plan_of(merge.latest_per_key(shaped.change_feed(spark, SMALL), ["USER_ID"], ORDER))
    partial = plan.index("WindowGroupLimit [USER_ID", plan.index("Exchange"))
    assert "Partial" in plan[partial:partial + 300]


def event(op, key, at, seq, value):
    return (op, key, datetime(2024, 1, 1, 0, at), seq, value)


EVENT_SCHEMA = "Op string, k long, ts timestamp, seq long, v string"


def silver(spark, *batches):
    state = None
    for batch in batches:
        versions = merge.to_versions(spark.createDataFrame(batch, EVENT_SCHEMA), ["k", "v"], ["ts", "seq"])
        state = merge.apply_changes(state, versions, ["k"], ["ts", "seq"])
    return {r["k"]: (r["v"], r["_is_deleted"]) for r in state.collect()}


def test_change_semantics(spark):
    assert silver(spark, [event("I", 1, 1, 1, "a"), event("U", 1, 2, 2, "b")]) == {1: ("b", False)}
    # A delete marks the row, of an unseen key as well.
    assert silver(spark, [event("I", 1, 1, 1, "a")], [event("D", 1, 2, 2, "a"), event("D", 9, 1, 3, None)]) == {
        1: ("a", True), 9: (None, True),
    }
    # A later change revives it.
    assert silver(spark, [event("D", 1, 2, 2, "a")], [event("I", 1, 3, 3, "n")]) == {1: ("n", False)}
    # A late change does not.
    assert silver(spark, [event("D", 1, 2, 2, "a")], [event("I", 1, 1, 1, "n")]) == {1: ("a", True)}
    # The sequence decides between equal commit times.
    assert silver(spark, [event("U", 1, 2, 5, "five")], [event("U", 1, 2, 4, "four")]) == {1: ("five", False)}


def test_current_rows(spark):
    df = spark.createDataFrame([(1, False), (2, True)], "k long, _is_deleted boolean")
    assert rows(merge.current_rows(df)) == [(1,)]


def test_rollback_and_retention(spark):
    df = spark.sql("""select 'a' as _batch_id, timestamp'2020-01-01' as _loaded_at
        union all select null, timestamp'2026-01-01' union all select 'b', timestamp'2026-01-01'""")
    assert merge.without_batch(df, "b").count() == 2
    assert merge.retained(df, datetime(2026, 2, 1)).count() == 2


VERSION_SCHEMA = "k long, v string, ts timestamp, seq long, _is_deleted boolean"


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_split_gives_the_same_state(spark, folder, seed):
    """Random order, random batches, one batch replayed."""
    pick = random.Random(seed)
    events = [event(pick.choice("IUD"), pick.randrange(12), pick.randrange(50), i, f"v{i}") for i in range(150)]
    expected = silver(spark, events)
    pick.shuffle(events)
    cuts = sorted(pick.sample(range(1, 150), 3))
    batches = [events[a:b] for a, b in zip([0, *cuts], [*cuts, 150])]
    table = VersionedTable(spark, folder, T.StructType.fromDDL(VERSION_SCHEMA), ["k"], buckets=4)
    for i in [0, 1, 1, 2, 3]:
        versions = merge.to_versions(spark.createDataFrame(batches[i], EVENT_SCHEMA), ["k", "v"], ["ts", "seq"])
        table.apply(versions, ["ts", "seq"], f"b{i}")
    assert {r["k"]: (r["v"], r["_is_deleted"]) for r in table.read().collect()} == expected
    assert table.version() == 4


def test_versions(spark, folder, target, changes):
    table = VersionedTable(spark, folder, target.schema, ["k"], buckets=4)
    assert table.read().count() == 0 and table.version() == 0
    first = table.upsert(target, "b1")
    table.delete_insert(changes, "b2")
    assert table.upsert(changes, "b2") is None
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    assert rows(table.read(first)) == rows(target)
    table.restore(first, "undo")
    assert rows(table.read()) == rows(target)
    # A batch of nothing is remembered, and changes nothing.
    table.upsert(changes.limit(0), "empty")
    assert rows(table.read()) == rows(target) and table.snapshot(batch="empty").has_batch


def test_a_commit_touches_only_its_buckets(spark, folder):
    table = VersionedTable(spark, folder, T.StructType.fromDDL(SCHEMA), ["k"], buckets=16)
    table.upsert(spark.range(200).selectExpr("id as k", "'x' as v"), "b1")
    table.upsert(spark.createDataFrame([(5, "y")], SCHEMA), "b2")
    folders = table.snapshot().live
    assert sorted(folders.values()).count(2) == 1 and len(folders) == 16
    assert table.read().filter("v = 'y'").count() == 1 and table.read().count() == 200


def test_emptied_buckets_and_wider_schema(spark, folder, target):
    schema = T.StructType.fromDDL(SCHEMA + ", _batch_id string")
    table = VersionedTable(spark, folder, schema, ["k"], buckets=2)
    table.upsert(target.withColumn("_batch_id", F.lit("b1")), "b1")
    table.delete_batch("b1", "undo")
    assert table.read().count() == 0
    table.upsert(target.withColumn("_batch_id", F.lit("b2")), "b2")
    wider = VersionedTable(spark, folder, T.StructType([*schema.fields, T.StructField("extra", T.StringType())]), ["k"], 2)
    assert {r["extra"] for r in wider.read().collect()} == {None}


def test_half_written_commit_is_not_seen(spark, folder, target, changes):
    table = VersionedTable(spark, folder, target.schema, ["k"], buckets=2)
    table.upsert(target, "b1")
    # Data of version 2 lies there, but the log does not mention it.
    changes.withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{folder}/data/v=2")
    assert rows(table.read()) == rows(target)
    table.upsert(changes, "b2")
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_null_keys_and_repeated_keys(spark, target):
    null_key = spark.createDataFrame([(None, "x")], SCHEMA)
    once = merge.delete_insert(target, null_key, ["k"])
    assert rows(merge.delete_insert(once, null_key, ["k"]).na.fill({"k": -1})) == rows(once.na.fill({"k": -1}))
    repeated = spark.createDataFrame([(2, "B"), (2, "C"), (9, "D"), (9, "D")], SCHEMA)
    got = merge.upsert(target, repeated, ["k"])
    assert [r for r in rows(got) if r[0] in (2, 9)] == [(2, "C"), (9, "D")]


def test_another_layout_is_refused(spark, folder, target):
    VersionedTable(spark, folder, target.schema, ["k"], buckets=4).upsert(target, "b1")
    for keys, buckets in ((["k"], 8), (["v"], 4)):
        other = VersionedTable(spark, folder, target.schema, keys, buckets)
        with pytest.raises(ValueError, match="laid out"):
            other.upsert(target, "b2")
        assert rows(other.read()) == rows(target)


def test_a_batch_taken_back_may_come_again(spark, folder, target):
    schema = T.StructType.fromDDL(SCHEMA + ", _batch_id string")
    table = VersionedTable(spark, folder, schema, ["k"], buckets=2)
    load = target.withColumn("_batch_id", F.lit("b1"))
    first = table.upsert(load, "b1")
    assert table.upsert(load, "b1") is None
    table.delete_batch("b1", "undo")
    assert table.upsert(load, "b1") is not None and table.read().count() == target.count()
    later = table.upsert(load.withColumn("v", F.lit("z")), "b2")
    table.restore(first, "undo-b2")
    assert table.upsert(load.withColumn("v", F.lit("z")), "b2") > later


def test_key_text_does_not_depend_on_the_zone(spark):
    from plumbline.functions.digest import key_bucket

    df = spark.sql("select timestamp_micros(1700000000123456) as t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = set()
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found.add(df.select(key_bucket(df, ["t"], 1000)).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(found) == 1
