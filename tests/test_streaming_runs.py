from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL
from plumbline.mdm import ACTIVITY, CUSTOMER, MATERIAL, VENDOR
from plumbline.operators import ledger, merge
from plumbline.operators.incremental import newer_than
from plumbline.operators.monitor import debounced
from plumbline.operators.transform import normalise
from plumbline.plans import runs
from plumbline.sinks.versioned import VersionedTable
from plumbline.sources import shaped
from plumbline.streaming import cdc
from plumbline.streaming.debounce import debounced_stream

AT = datetime(2026, 4, 21)
STORED = {"USER_ID": T.LongType(), "AMOUNT": T.DoubleType()}


def feed(spark):
    df = shaped.change_feed(spark, SMALL)
    return df.withColumn(cdc.COMMITTED, F.col(cdc.COMMITTED).cast("timestamp"))


def state_rows(df):
    return {r["user_id"]: (r["event_type"], r["amount"], r["_is_deleted"]) for r in df.collect()}


def test_stream_equals_batch_in_any_split(spark, folder):
    events = feed(spark)
    expected = state_rows(merge.apply_changes(None, cdc.versions_of(events, ACTIVITY), ["user_id"], cdc.ORDER))
    schema = cdc.feed_schema(ACTIVITY, STORED)
    for part in events.randomSplit([0.3, 0.3, 0.4], seed=5)[::-1]:
        part.write.mode("append").parquet(f"{folder}/feed")
        table = runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=4, max_files=2)
    assert state_rows(table.read()) == expected
    version = table.version()
    # Nothing new: nothing is committed.
    runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=4)
    assert table.version() == version
    bronze = spark.read.parquet(f"{folder}/bronze")
    assert bronze.count() == events.count()
    assert bronze.filter("_cdc_source_file is null or _cdc_ingested_at is null").count() == 0


def test_silver_merges_while_bronze_ingests(spark, folder, monkeypatch):
    """both steps run at once; a failing merge ends both, and the next run takes up where they were."""
    events, schema = feed(spark), cdc.feed_schema(ACTIVITY, STORED)
    events.repartition(8).write.parquet(f"{folder}/feed")
    ingest_bronze, merge_silver, ingests, beside = cdc.ingest_bronze, cdc.merge_silver, [], []

    def ingest(*args):
        ingests.append(ingest_bronze(*args))
        return ingests[-1]

    def merged(*args, **kwargs):
        beside.append(ingests[-1].isActive)
        if len(beside) == 2:
            raise RuntimeError("lost")
        return merge_silver(*args, **kwargs)

    monkeypatch.setattr(runs, "POLL_SECONDS", 0.05, raising=False)
    monkeypatch.setattr(cdc, "ingest_bronze", ingest)
    monkeypatch.setattr(cdc, "merge_silver", merged)
    with pytest.raises(RuntimeError, match="lost"):
        runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=2, max_files=1)
    assert beside[0] and not ingests[0].isActive
    table = runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=2, max_files=1)
    assert table.version() == 8
    assert spark.read.parquet(f"{folder}/bronze").count() == events.count()
    expected = merge.apply_changes(None, cdc.versions_of(events, ACTIVITY), ["user_id"], cdc.ORDER)
    assert state_rows(table.read()) == state_rows(expected)


def test_lost_checkpoint_replays_without_harm(spark, folder):
    events = feed(spark)
    schema = cdc.feed_schema(ACTIVITY, STORED)
    events.write.parquet(f"{folder}/feed")
    table = runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=2)
    before = state_rows(table.read())
    cdc.merge_silver(
        spark, f"{folder}/bronze", table, f"{folder}/other", ACTIVITY, cdc.bronze_schema(schema)
    ).awaitTermination()
    assert state_rows(table.read()) == before


def test_feed_with_a_missing_and_then_a_new_column(spark, folder):
    schema = cdc.feed_schema(ACTIVITY, STORED)
    events = feed(spark)
    events.filter("_seq < 300").drop("EMAIL").write.parquet(f"{folder}/feed")
    runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=2)
    events.filter("_seq >= 300").write.mode("append").parquet(f"{folder}/feed")
    table = runs.run_cdc(spark, ACTIVITY, f"{folder}/feed", folder, schema, buckets=2)
    latest = merge.latest_per_key(events, ["USER_ID"], cdc.ORDER)
    assert table.read().filter("email is not null").count() == latest.filter("_seq >= 300").count()


def test_both_targets(spark, folder):
    events = feed(spark)
    schema = cdc.bronze_schema(cdc.feed_schema(ACTIVITY, STORED))
    events.withColumns({"_cdc_ingested_at": F.lit(AT), "_cdc_source_file": F.lit("f")}).write.parquet(f"{folder}/bronze")
    sides = [VersionedTable(spark, f"{folder}/{n}", cdc.silver_schema(ACTIVITY), ["user_id"], 2) for n in "ab"]
    cdc.feed_targets(spark, f"{folder}/bronze", *sides, f"{folder}/ckpt", ACTIVITY, schema).awaitTermination()
    plain, masked = (t.read() for t in sides)
    assert plain.count() == masked.count() > 0
    joined = plain.join(masked.select("user_id", F.col("email").alias("hash")), "user_id")
    assert joined.filter(F.sha2("email", 256) != F.col("hash")).count() == 0


def test_debounce_stream_is_part_of_the_batch_answer(spark, folder):
    arrivals = feed(spark).select(
        F.col(cdc.COMMITTED).alias("ts"), F.concat(F.lit("cdc/sap/T"), F.col("USER_ID") % 3, F.lit("/f")).alias("path")
    )
    arrivals.orderBy("ts").coalesce(1).write.parquet(f"{folder}/in")
    stream = debounced_stream(spark.readStream.schema(arrivals.schema).parquet(f"{folder}/in"))
    stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/ckpt").trigger(
        availableNow=True
    ).start(f"{folder}/out").awaitTermination()
    got = {(r[0], r[1]) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {(r[0], r[1]) for r in debounced(arrivals, "ts", "path").collect()}


@pytest.fixture
def run(spark, folder):
    return runs.Run(spark, folder, buckets=4)


def test_run_table(spark, run):
    raw = shaped.customers(spark, SMALL)
    done = runs.run_table(run, CUSTOMER, "b1", lambda mark: newer_than(raw, "ERDAT", mark), AT)
    assert (done.status, done.rows) == ("SUCCEEDED", raw.count())
    expected = normalise(raw, CUSTOMER)
    stored = run.target(CUSTOMER, "operational").read()
    assert stored.select(*CUSTOMER.columns).exceptAll(expected).count() == 0 and stored.count() == expected.count()
    hashed = run.target(CUSTOMER, "analytical").read()
    assert hashed.filter(F.length("email") != 64).count() == 0
    assert {r["_batch_id"] for r in hashed.select("_batch_id").distinct().collect()} == {"b1"}
    assert runs.run_table(run, CUSTOMER, "b1", lambda mark: raw, AT).status == "SKIPPED"
    assert run.ledger.watermark(run.job, CUSTOMER.fqn) == raw.agg(F.max("ERDAT")).first()[0]
    # The next run starts from the watermark.
    marks = []

    def source(mark):
        marks.append(mark)
        return newer_than(raw, "ERDAT", mark)

    assert runs.run_table(run, CUSTOMER, "b2", source, AT).status == "SUCCEEDED"
    assert marks[0] == run.ledger.watermark(run.job, CUSTOMER.fqn)
    assert run.target(CUSTOMER, "operational").read().count() == expected.count()


def test_the_source_is_read_once(spark, run, folder, monkeypatch):
    """The source is gone as soon as the extract is written, and all checks still run and say what they said of two reads."""
    import shutil

    from plumbline.operators import reconcile

    raw = shaped.customers(spark, SMALL)
    raw.write.parquet(f"{folder}/source")
    expected = {(r["layer"], r["status"], r["message"], r["evidence"]) for r in reconcile.layer_rows(
        normalise(raw, CUSTOMER), normalise(raw, CUSTOMER), CUSTOMER).collect()}
    calls, write = [], runs.write_extract

    def source(mark):
        calls.append(mark)
        return spark.read.parquet(f"{folder}/source")

    def then_gone(*args):
        written = write(*args)
        shutil.rmtree(f"{folder}/source")
        return written

    monkeypatch.setattr(runs, "write_extract", then_gone)
    done = runs.run_table(run, CUSTOMER, "b1", source, AT)
    assert (done.status, done.rows, len(calls)) == ("SUCCEEDED", raw.count(), 1)
    reports = spark.read.json(f"{run.report(CUSTOMER, 'b1')}/*").collect()
    assert {r["phase"] for r in reports} == {"post_extract", "post_load_operational", "post_load_analytical"}
    for phase in {r["phase"] for r in reports}:
        assert {(r["layer"], r["status"], r["message"], r["evidence"]) for r in reports if r["phase"] == phase} == expected


def test_what_is_lost_between_reading_and_staging_is_seen(spark, run, monkeypatch):
    raw = shaped.materials(spark, SMALL)
    write = runs.write_batch

    def lossy(df, path, *more):
        return write(df.filter("material_number not like '%7'"), path, *more)

    with monkeypatch.context() as patch:
        patch.setattr(runs, "write_batch", lossy)
        outcome = runs.run_table(run, MATERIAL, "b1", lambda mark: raw, AT)
    assert outcome.status == "FAILED" and "post_extract checksum_bands" in outcome.detail and "post_extract row_count" in outcome.detail
    bands = spark.read.json(f"{run.report(MATERIAL, 'b1')}/extract").filter("layer = 'checksum_bands'").first()
    assert "bucket(s) differ" in bands["message"] and bands["evidence"].count('"bucket"') == 10
    assert run.target(MATERIAL, "operational").read().count() == 0


def test_checks_after_the_load_read_the_rewritten_buckets_alone(spark, run):
    raw = shaped.vendors(spark, SMALL)
    for batch in ("b1", "b2"):
        assert runs.run_table(run, VENDOR, batch, lambda mark: raw, AT).status == "SUCCEEDED"
    table = run.target(VENDOR, "operational")
    files = {f.split("/data/")[1].split("/")[0] for f in table.written(table.version()).inputFiles()}
    assert files == {f"v={table.version()}"} and table.written(None).count() == 0


def test_measures_equal_a_full_report(spark):
    from plumbline.mdm import ORDERS
    from plumbline.operators import reconcile

    clean = shaped.normalised_orders(spark, SMALL)
    for kinds in ((), ("dropped",), ("nulled",), ("duplicated",), ("scaled", "swapped")):
        damaged = shaped.damaged_orders(clean, *kinds) if kinds else clean.repartition(3)
        found = reconcile.measured({"s": (clean, False), "t": (damaged, True)}, ORDERS)
        got = reconcile.reports_of(spark, {"x": (found["s"], found["t"], lambda: reconcile.bands_of(clean, damaged, ORDERS))}, ORDERS, "b")["x"]
        full = reconcile.reconcile(clean, damaged, ORDERS, "b").collect()
        assert sorted(map(str, (tuple(r.values()) for r in got))) == sorted(map(str, map(tuple, full)))


def test_failed_check_stops_before_the_load(spark, run):
    raw = shaped.vendors(spark, SMALL)
    twice = raw.unionByName(raw)
    outcome = runs.run_table(run, VENDOR, "b1", lambda mark: twice, AT)
    assert outcome.status == "FAILED" and "pk_uniqueness" in outcome.detail
    assert run.target(VENDOR, "operational").read().count() == 0
    assert run.ledger.watermark(run.job, VENDOR.fqn) is None
    # A failed batch may run again.
    assert runs.run_table(run, VENDOR, "b1", lambda mark: raw, AT).status == "SUCCEEDED"
    reports = spark.read.json(f"{run.report(VENDOR, 'b1')}/*")
    assert reports.groupBy("phase").count().count() == 3


def test_changed_vendors_are_loaded_again(spark, run):
    raw = shaped.vendors(spark, SMALL)
    changed = raw.withColumn("NAME1", F.lit("changed"))
    for batch, rows in (("b1", raw), ("b2", changed)):
        assert runs.run_table(run, VENDOR, batch, lambda mark, rows=rows: newer_than(rows, "ERDAT", mark), AT).status == "SUCCEEDED"
    assert {r[0] for r in run.target(VENDOR, "operational").read().select("vendor_name").distinct().collect()} == {"changed"}


def test_whole_days_are_read_again(spark):
    days = spark.createDataFrame([("20240101",), ("20240102",), ("20240103",)], "day string")
    assert newer_than(days, "day", "20240102").count() == 2
    assert newer_than(days.select(F.to_timestamp("day", "yyyyMMdd").alias("t")), "t", "2024-01-02 00:00:00").count() == 1
    assert newer_than(days.select(F.to_date("day", "yyyyMMdd").alias("d")), "d", "2024-01-02").count() == 2


def test_failed_load_is_put_back_and_may_run_again(spark, run, monkeypatch):
    raw = shaped.vendors(spark, SMALL)
    assert runs.run_table(run, VENDOR, "b1", lambda mark: raw.filter("LIFNR < '0000000005'"), AT).status == "SUCCEEDED"
    before = {side: run.target(VENDOR, side).read().count() for side in ("operational", "analytical")}

    def broken(self, rows, batch):
        raise RuntimeError("target down")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "delete_insert", broken)
        outcome = runs.run_table(run, VENDOR, "b2", lambda mark: raw, AT)
    assert outcome.status == "FAILED" and "target down" in outcome.detail
    assert {side: run.target(VENDOR, side).read().count() for side in before} == before
    assert runs.run_table(run, VENDOR, "b2", lambda mark: raw, AT).status == "SUCCEEDED"
    assert {run.target(VENDOR, side).read().count() for side in before} == {raw.count()}


def test_run_many(spark, run):
    work = []
    for name in ("MARA", "KNA1", "LFA1"):
        df, contract = shaped.extract(spark, SMALL, name)
        work.append((contract, f"b-{name}", lambda mark, df=df: df))
    outcomes = runs.run_many(run, work)
    assert [o.status for o in outcomes] == ["SUCCEEDED"] * 3
    assert {r["status"] for r in ledger.latest_status(run.ledger.entries()).collect()} == {"SUCCEEDED"}
    assert run.target(MATERIAL, "operational").read().count() == outcomes[0].rows
