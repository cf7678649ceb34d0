import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.mdm import ACTIVITY
from plumbline.operators import merge
from plumbline.sinks import clustered
from plumbline.sinks.versioned import VersionedTable
from plumbline.streaming.evolution import RESCUED, EvolvingFeed, columns_of_files, with_rescued

COLUMNS = ["k", "at"]


def points(spark, n=6000):
    """Keys and times that have nothing to do with each other; a third of the rows has one key, and some have none."""
    k = F.expr("case when id % 3 = 0 then 7 when id % 50 = 1 then null else pmod(xxhash64(id), 100000) end")
    return spark.range(n).select("id", k.cast("long").alias("k"), F.timestamp_seconds(F.pmod(F.xxhash64(F.col("id") + 1), F.lit(10 ** 7))).alias("at"))


def test_files_are_boxes_that_do_not_overlap(spark, folder):
    df = points(spark)
    clustered.write_clustered(df, COLUMNS, folder, files=64)
    assert spark.read.parquet(folder).drop(clustered.CLUSTER).exceptAll(df).count() == 0
    ranges = clustered.file_ranges(spark, folder, COLUMNS)
    rows = ranges.collect()
    assert clustered.overlaps(ranges).count() == 0 and sum(r["rows"] for r in rows) == 6000
    assert max(r["rows"] for r in rows) <= 3 * 6000 / len(rows)
    # A tenth of either column opens far fewer files than all of them, and none that is needed is left out.
    lows = {"k": (50_000, 60_000), "at": ("1970-02-20", "1970-03-03")}
    for column, (low, high) in lows.items():
        value = [F.lit(v).cast(dict(df.dtypes)[column]) for v in (low, high)]
        opened = ranges.filter((F.col(f"greatest_{column}") >= value[0]) & (F.col(f"least_{column}") <= value[1]))
        needed = spark.read.parquet(folder).filter(F.col(column).between(*value)).select(F.col("_metadata.file_path").alias("file")).distinct()
        assert needed.count() > 0 and needed.join(opened, "file", "left_anti").count() == 0
        assert opened.count() <= len(rows) / 2
    assert clustered.files_for(ranges, "k", 7, 7).count() >= len(rows) / 4


def test_layout_of_other_tables(spark, folder):
    for i, (df, files) in enumerate([(points(spark, 0), 4), (points(spark, 1), 4), (points(spark, 500).withColumn("k", F.lit(1)), 3),
                                     (points(spark, 500).withColumns({"k": F.col("k").cast("string"), "at": F.to_date("at")}), 3)]):
        clustered.write_clustered(df, COLUMNS, f"{folder}/{i}", files)
        stored = spark.read.parquet(f"{folder}/{i}")
        assert stored.drop(clustered.CLUSTER).exceptAll(df).count() == 0 and stored.count() == df.count()
        assert clustered.overlaps(clustered.file_ranges(spark, f"{folder}/{i}", COLUMNS)).count() == 0


def test_bits_are_interleaved(spark):
    row = spark.range(1).select(clustered.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z")).first()
    assert row["z"] == 0b100111
    with pytest.raises(ValueError):
        clustered.interleaved([F.lit(1)] * 11, 6)
    cells = spark.createDataFrame([(None,), (1,), (5,), (9,)], "v int").select("v", clustered.cell_of(F.col("v"), [5, 8]).alias("c")).collect()
    assert [(r["v"], r["c"]) for r in cells] == [(None, 0), (1, 0), (5, 1), (9, 2)]


# --- columns found in files ----------------------------------------------------------------------


def changes(spark, first, n):
    return spark.range(first, first + n).selectExpr(
        "'U' as Op", "timestamp '2024-01-01' as _dms_committed_at", "id as _seq", "id as USER_ID", "'e' as EVENT_TYPE", "id / 2 as AMOUNT",
        "'m' as EMAIL")


STORED = {"USER_ID": T.LongType(), "AMOUNT": T.DoubleType()}


def test_unknown_columns_are_kept_and_filled_in_later(spark, folder):
    feed = f"{folder}/a feed"
    stream = EvolvingFeed(spark, feed, f"{folder}/bronze", f"{folder}/ckpt", max_files=2)
    changes(spark, 0, 10).coalesce(1).write.parquet(feed)
    stream.ingest(ACTIVITY, STORED)
    assert stream.found() == []
    more = changes(spark, 10, 10).withColumns({"SCORE": F.expr("if(_seq % 2 = 0, _seq, null)"), "more": F.struct("_seq")})
    more.coalesce(1).write.mode("append").parquet(feed)
    changes(spark, 20, 10).withColumn("LAST", F.lit("x")).coalesce(1).write.mode("append").parquet(feed)
    stream.ingest(ACTIVITY, STORED)
    stream.ingest(ACTIVITY, STORED)
    assert {f.name for f in stream.found()} == {"SCORE", "more", "LAST"}
    bronze = stream.read(ACTIVITY, STORED)
    got = {r["_seq"]: r[RESCUED] for r in bronze.collect()}
    assert bronze.count() == 30 and got[3] is None and got[12] == {"SCORE": "12", "more": "{12}"} and got[13] == {"more": "{13}"}
    assert got[25] == {"LAST": "x"}
    filled = with_rescued(bronze.withColumns({"SCORE": F.lit(None).cast("long"), "LAST": F.lit(None).cast("int")}), "SCORE", "LAST")
    assert {r["_seq"]: (r["SCORE"], r["LAST"]) for r in filled.collect()}[12] == (12, None)
    assert filled.filter("SCORE is not null").count() == 5 and filled.filter("LAST is not null").count() == 0


def test_a_run_that_failed_for_another_reason_says_so(spark, folder):
    changes(spark, 0, 4).write.parquet(f"{folder}/feed")
    changes(spark, 4, 4).withColumn("EMAIL", F.lit(1.5)).write.mode("append").parquet(f"{folder}/feed")
    with pytest.raises(StreamingQueryException):
        EvolvingFeed(spark, f"{folder}/feed", f"{folder}/bronze", f"{folder}/ckpt").ingest(ACTIVITY, STORED)


def test_footers_only(spark, folder):
    for i, names in enumerate((["a"], ["a", "b"], ["c"])):
        spark.range(3).select(*[F.col("id").alias(n) for n in names]).coalesce(1).write.parquet(f"{folder}/{i}")
    files = [glob.glob(os.path.join(folder, str(i), "*.parquet"))[0] for i in range(3)]
    assert {f.name for f in columns_of_files(spark, files)} == {"a", "b", "c"}


# --- a batch taken back --------------------------------------------------------------------------


def test_rows_that_a_batch_replaced_return(spark, folder):
    schema = T.StructType.fromDDL("k int, v string, _batch_id string")
    table = VersionedTable(spark, folder, schema, ["k"], 4)

    def load(batch, name, *rows):
        table.upsert(spark.createDataFrame([(k, v, batch) for k, v in rows], schema), name)

    load("a", "a", (1, "a"), (2, "a"), (3, "a"), (None, "a"))
    load("b", "b#12345678", (2, "b"), (3, "b"), (4, "b"), (None, "b"))
    load("c", "c", (3, "c"), (5, "c"))
    table.undo_batch("b", "undo")
    after = [(None, "a"), (1, "a"), (2, "a"), (3, "c"), (5, "c")]
    assert sorted(((r["k"], r["v"]) for r in table.read().collect()), key=str) == sorted(after, key=str)
    assert table.undo_batch("b", "again") is None and table.undo_batch("never", "none") is None
    assert table.read().count() == 5
    load("b", "b#87654321", (1, "B"))
    assert {r["k"]: r["v"] for r in table.read().collect()}[1] == "B"


def test_undo_as_a_function(spark):
    now = spark.createDataFrame([(1, "x", "a"), (2, "y", "b")], "k int, v string, _batch_id string")
    before = spark.createDataFrame([(1, "w", "a"), (2, "w", "a"), (3, "w", "a")], now.schema)
    assert sorted(map(tuple, merge.undo_batch(now, before, ["k"], "b").collect())) == [(1, "x", "a"), (2, "w", "a")]
