import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from plumbline.mdm import ACTIVITY, MATERIAL, VENDOR
from plumbline.operators import sketches
from plumbline.plans import runs
from plumbline.plans.catalog import STORED, half_feeds
from plumbline.sinks import files as sink_files
from plumbline.sinks.ledger import Ledger
from plumbline.sinks.versioned import VersionedTable
from plumbline.sources import shaped
from plumbline.sources.files import table
from plumbline.streaming import cdc
from plumbline.streaming.debounce import first_arrivals_stream
from plumbline.streaming.queue import QueueReader


# --- queue ---------------------------------------------------------------------------------------


def requests(spark, n):
    return spark.range(n).selectExpr("id div 3 as request", "id as value")


def loads(reader, queue):
    return sorted((r["load"], r["value"]) for r in reader.loaded(queue.schema).collect())


def test_every_request_is_loaded_once(spark, folder):
    reader = QueueReader(spark, folder, "request")
    assert reader.consume(requests(spark, 0)) is None and loads(reader, requests(spark, 0)) == []
    first = reader.consume(requests(spark, 30))
    assert (first.number, first.after, first.up_to) == (1, None, 9)
    assert reader.consume(requests(spark, 30)) is None

    def dies_after_a_part(rows, path):
        rows.limit(4).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        reader.consume(requests(spark, 60), write=dies_after_a_part)
    # What the lost load has left is not seen, and more requests have come when it is done again.
    again = QueueReader(spark, folder, "request")
    assert len(loads(again, requests(spark, 0))) == 30
    second = again.consume(requests(spark, 90))
    assert (second.number, second.after, second.up_to) == (2, 9, 19)
    assert again.consume(requests(spark, 90)).up_to == 29
    assert loads(again, requests(spark, 0)) == [(1 + v // 30, v) for v in range(90)]


def test_pointer_and_gate(spark, folder):
    reader = QueueReader(spark, folder, "request")

    def not_green():
        raise RuntimeError("chain ended with 'R'")

    with pytest.raises(RuntimeError):
        reader.consume(requests(spark, 30), ready=not_green)
    assert reader.committed() == 0 and reader.next_load(requests(spark, 30)).number == 1
    assert reader.consume(requests(spark, 30), ready=lambda: None).number == 1
    # The pointer file may be lost: the commits decide.
    os.remove(f"{folder}/pointer.json")
    assert reader.committed() == 1 and reader.consume(requests(spark, 30)) is None


# --- streams -------------------------------------------------------------------------------------


def test_targets_of_two_paces_end_equal(spark, folder):
    schema = cdc.feed_schema(ACTIVITY, STORED)
    silver, fast, slow = (VersionedTable(spark, f"{folder}/{n}", cdc.silver_schema(ACTIVITY), ["user_id"], 2) for n in ("silver", "fast", "slow"))
    lag = []
    for part in half_feeds(spark, SMALL):
        part.withColumn("_dms_committed_at", F.col("_dms_committed_at").cast("timestamp")).write.mode("append").parquet(f"{folder}/feed")
        cdc.ingest_bronze(spark, f"{folder}/feed", f"{folder}/bronze", f"{folder}/ckpt", schema).awaitTermination()
        cdc.merge_silver(spark, f"{folder}/bronze", silver, f"{folder}/ckpt", ACTIVITY, cdc.bronze_schema(schema), changes_dir=f"{folder}/changes").awaitTermination()
        cdc.follow_changes(spark, f"{folder}/changes", fast, f"{folder}/fast-ckpt", ACTIVITY, max_files=1).awaitTermination()
        lag.append(slow.read().count())
    # Changes that were written twice, as after a failure, change nothing.
    spark.read.parquet(f"{folder}/changes").limit(50).write.mode("append").parquet(f"{folder}/changes")
    cdc.follow_changes(spark, f"{folder}/changes", slow, f"{folder}/slow-ckpt", ACTIVITY).awaitTermination()
    rows = [sorted(map(str, t.read().collect())) for t in (silver, fast, slow)]
    assert lag == [0, 0] and rows[0] == rows[1] == rows[2] and len(rows[0]) > 0


def test_first_arrivals_over_several_triggers(spark, folder):
    path = "cdc/sap/T1/2024/01/01/10/x.parquet"
    parts = [
        [("10:03:00", path), ("10:01:00", path), ("10:02:00", "raw/sap/T1/x")],
        # Out of order, but within what is waited for: it is the first of its period.
        [("10:00:30", path), ("10:12:00", path)],
        [("10:40:00", "other/none")], [("10:40:30", "other/none")],
        # Its period has been closed.
        [("10:00:10", path), ("10:41:00", path)],
        [("10:59:00", "other/none")], [("11:59:00", "other/none")],
    ]
    for rows in parts:
        df = spark.createDataFrame([(f"2024-01-01 {t}", p) for t, p in rows], "ts string, path string").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    arrivals = spark.readStream.schema("ts timestamp, path string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    first_arrivals_stream(arrivals).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/ckpt").trigger(
        availableNow=True).start(f"{folder}/out").awaitTermination()
    got = {(f"{r['period_start']:%H:%M}", f"{r['triggered_at']:%H:%M:%S}") for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {("10:00", "10:00:30"), ("10:10", "10:12:00"), ("10:40", "10:41:00")}


# --- stores --------------------------------------------------------------------------------------


def stored_files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_purge_rewrites_touched_partitions_alone(spark, folder):
    folder = f"{folder}/table"
    spark.range(1000).selectExpr("id", "id div 100 as part", "if(id = 950, null, id) as age").write.partitionBy("part").parquet(folder)
    before = stored_files(folder)
    touched = sink_files.purge_partitions(spark, folder, "part", F.col("age") >= 250)
    assert touched == [0, 1, 2, 9]
    left = spark.read.parquet(folder)
    assert sorted(r["id"] for r in left.collect()) == [i for i in range(250, 1000) if i != 950]
    after = stored_files(folder)
    kept = {f for f in before if any(f"part={k}/" in f for k in range(3, 9))}
    assert kept <= after and not (before - kept) & after and not os.path.exists(f"{folder}/part=0")
    assert sink_files.purge_partitions(spark, folder, "part", F.col("age") >= 250) == [] and stored_files(folder) == after


def test_compacted_ledger_answers_alike(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    ledger.compact()
    for k in range(6):
        ledger.start("load", f"b{k}")
        if k % 2:
            ledger.fail("load", f"b{k}", "no")
        else:
            ledger.succeed("load", f"b{k}", 10, table="t", watermark=str(k))
    before = sorted(map(str, ledger.entries().collect()))
    assert len(ledger.entries().inputFiles()) == 12
    ledger.compact()
    assert len(ledger.entries().inputFiles()) == 1 and sorted(map(str, ledger.entries().collect())) == before
    assert ledger.watermark("load", "t") == "4" and ledger.is_processed("load", "b0") and not ledger.start("load", "b0") and ledger.start("load", "b1")


# --- runs, sketches ------------------------------------------------------------------------------


def test_needed_tables_come_first(spark, folder):
    run = runs.Run(spark, folder, buckets=2)
    done = []

    def work(contract, rows, fails=False):
        def source(mark):
            if fails:
                raise RuntimeError("source down")
            done.append(contract.table)
            return rows
        return contract, f"b-{contract.table}", source

    vendors, materials = shaped.vendors(spark, SMALL), shaped.materials(spark, SMALL)
    broken = runs.run_many(run, [work(MATERIAL, materials), work(VENDOR, vendors, fails=True)], {"MARA": ["LFA1"]})
    assert [(o.table, o.status) for o in broken] == [("MARA", "HELD"), ("LFA1", "FAILED")] and done == []
    mended = runs.run_many(run, [work(MATERIAL, materials), work(VENDOR, vendors)], {"MARA": ["LFA1"]})
    assert [o.status for o in mended] == ["SUCCEEDED", "SUCCEEDED"] and done == ["LFA1", "MARA"]
    with pytest.raises(ValueError):
        runs.run_many(run, [work(MATERIAL, materials)], {"MARA": ["NONE"]})
    with pytest.raises(ValueError):
        runs.run_many(run, [work(MATERIAL, materials), work(VENDOR, vendors)], {"MARA": ["LFA1"], "LFA1": ["MARA"]})


def test_merged_sketches_keep_their_rank_error(spark):
    lines = table(spark, SMALL, "lineitem").withColumn("odd", F.when(F.col("l_orderkey") % 5 == 0, float("nan")).when(F.col("l_orderkey") % 5 == 1, None).otherwise(F.col("l_tax")))
    columns = ["l_extendedprice", "l_quantity", "odd"]
    months = sketches.period_sketches(lines, F.date_format("l_shipdate", "yyyy-MM"), columns)
    shares = [0.01, 0.25, 0.5, 0.95, 0.99]
    found = sketches.quantiles(sketches.merged(months), shares).collect()
    assert len(found) == len(columns) * len(shares)
    for r in found:
        c = F.col(r["column_name"])
        below, upto, n = lines.filter(~F.isnan(c.cast("double"))).agg(F.count_if(c < r["value"]), F.count_if(c <= r["value"]), F.count(c)).first()
        slack = sketches.rank_error() * n + 1
        assert r["n"] == n and below - slack <= r["share"] * n <= upto + slack
