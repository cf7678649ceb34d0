import os

from pyspark.sql import functions as F

from plumbline.plans.catalog import write_triggers
from plumbline.streaming.debounce import first_arrivals_stream


def test_a_trigger_takes_as_many_files_as_any_other(spark, folder):
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60)
    arrived = spark.range(0, 3000, 1, 6).select(
        ts.alias("ts"), F.concat(F.lit("cdc/sap/T"), F.col("id") % 3, F.lit("/2024/01/01/00/"), "id", F.lit(".parquet")).alias("path"),
        F.when(F.col("id") < 2000, 0).when(F.col("id") < 2900, 1).otherwise(2).alias("trigger"))
    close = spark.range(1).select((F.lit("2024-02-01").cast("timestamp")).alias("ts"), F.lit("none").alias("path"))
    assert write_triggers(arrived, close, 3, f"{folder}/staged", f"{folder}/in", file_rows=25) == 4
    files = sorted((e for e in os.scandir(f"{folder}/in") if e.name.endswith(".parquet")), key=lambda e: e.stat().st_mtime_ns)
    ids = [[int(r["path"].rsplit("/", 1)[1][:-8]) for r in spark.read.parquet(f.path).collect()] for f in files[:-1]]
    assert len(ids) == 12 and all(ids) and sorted(i for part in ids for i in part) == list(range(3000))
    assert [{0 if i < 2000 else 1 if i < 2900 else 2 for i in part} for part in ids] == [{0}] * 4 + [{1}] * 4 + [{2}] * 4

    # A trigger without rows still has its file.
    gap = arrived.filter("trigger <> 1")
    assert write_triggers(gap, close, 3, f"{folder}/staged-gap", f"{folder}/in-gap", file_rows=25) == 1
    assert len([n for n in os.listdir(f"{folder}/in-gap") if n.endswith(".parquet")]) == 4

    stream = first_arrivals_stream(spark.readStream.schema("ts timestamp, path string").option("maxFilesPerTrigger", 4).parquet(f"{folder}/in"))
    query = stream.writeStream.format("memory").queryName("by_trigger").outputMode("append").option("checkpointLocation", f"{folder}/ckpt").trigger(
        availableNow=True).start()
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2000, 900, 100, 1]
    assert spark.table("by_trigger").count() == 3 * 600
