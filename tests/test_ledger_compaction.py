from datetime import datetime, timezone

from pyspark.sql import functions as F

from plumbline.sinks.ledger import MICROS, Ledger


def test_many_tasks_read_what_one_file_takes(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    at = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 86_400_000_001)
    spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "batch").otherwise("watermark").alias("kind"), F.lit("load").alias("job"), F.concat(F.lit("b"), "id").alias("name"),
        F.when(F.col("id") % 4 == 0, "FAILED").alias("status"), at.alias("at"), F.col("id").alias("row_count"),
        F.when(F.col("id") % 4 == 0, F.lit('a "line"\nand\tanother\r é')).alias("error_message"), F.lit(None).cast("string").alias("watermark"),
        F.col("id").alias("seq"),
    ).repartition(8).write.option("timestampFormat", MICROS).json(f"{ledger.path}/first")
    now = datetime(2025, 2, 4, 12, tzinfo=timezone.utc)
    entries = ledger.entries()
    kept = entries.filter((F.col("kind") == "watermark") | (F.col("at") >= F.lit(now) - F.expr("interval 30 days")))
    before = sorted(map(str, kept.collect()))
    assert 200 < len(before) < 220
    spark.sparkContext.setJobGroup("compaction", "compaction")
    try:
        # Files of a few bytes are read together unless an opened file counts for much.
        spark.conf.set("spark.sql.files.openCostInBytes", str(2**27))
        ledger.compact(now)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("compaction") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) == 8
    assert len(ledger.entries().inputFiles()) == 1 and sorted(map(str, ledger.entries().collect())) == before
