from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from plumbline.mdm import MATERIAL, PRICE_HISTORY, VENDOR
from plumbline.operators.transform import normalise, with_load_audit
from plumbline.sinks import files as sink_files
from plumbline.sinks import jdbc as sink_jdbc
from plumbline.sources import files, jdbc, shaped

AT = datetime(2026, 4, 21)


@pytest.fixture(scope="module")
def db(spark):
    database = jdbc.derby("tests")
    rows = spark.range(1000).selectExpr(
        "id as num", "concat('K', lpad(cast(id as string), 4, '0')) as code", "timestamp'2024-01-01' + make_dt_interval(0, 0, id) as ts",
        "if(id % 10 = 0, null, id) as holes",
    )
    rows.write.mode("overwrite").option("createTableColumnTypes", "code varchar(10)").jdbc(
        database.url, "big", properties=database.properties
    )
    return database


def test_scan_follows_the_column_type(spark, db):
    by_number = jdbc.scan(spark, db, "big", "num", 4)
    assert by_number.rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in by_number.select("num").collect()) == list(range(1000))
    by_time = jdbc.scan(spark, db, "big", "ts", 4)
    assert by_time.rdd.getNumPartitions() == 4 and by_time.count() == 1000
    assert jdbc.scan(spark, db, "big", None, 4).rdd.getNumPartitions() == 1


def test_slices_are_even_with_discovered_bounds(spark, db):
    df = jdbc.range_scan(spark, db, "big", "num", 4, '"num" >= 600')
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 400 and len(sizes) == 4 and max(sizes) - min(sizes) <= 2


def slice_sizes(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())


def test_even_slices_of_uneven_keys(spark):
    database = jdbc.derby("even")
    rows = spark.range(3000).selectExpr(
        "id as num", "cast(if(id % 3 = 0, 5, id * id * id) as bigint) as cube", "if(id % 10 = 0, null, id * id) as holes",
        "date_add(date'2024-01-01', cast(sqrt(id) as int)) as day", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id * id / 7) as ts",
        "cast(id * id / 3 as decimal(18,4)) as price", "exp(id / 300) as wide")
    sink_jdbc.write_table(rows, database, "uneven")
    for column in ("num", "holes", "day", "ts", "price", "wide"):
        df = jdbc.even_scan(spark, database, "uneven", column, 6)
        sizes = slice_sizes(df)
        nulls = 300 if column == "holes" else 0
        assert df.select("num").distinct().count() == df.count() == 3000, column
        assert len(sizes) == 6 and sizes[-1] - nulls <= 2 * sizes[0], (column, sizes)
    # A third of the rows have one value. Split by another column, no slice is left with all of them.
    whole = jdbc.even_scan(spark, database, "uneven", "cube", 6)
    assert slice_sizes(whole)[-1] >= 1000 and whole.count() == 3000
    split = jdbc.even_scan(spark, database, "uneven", "cube", 9, split_by="num")
    sizes = slice_sizes(split)
    assert split.select("num").distinct().count() == split.count() == 3000 and sizes[-1] <= 2 * (3000 / 9), sizes
    assert slice_sizes(jdbc.range_scan(spark, database, "uneven", "cube", 6))[-1] > 2000
    some = jdbc.even_scan(spark, database, "uneven", "day", 4, '"num" >= 2000')
    assert some.count() == 1000 and slice_sizes(some)[-1] <= 2 * 250
    assert jdbc.even_scan(spark, database, "uneven", "num", 4, '"num" < 0').count() == 0


def test_cut_points_keep_the_order_of_the_database():
    assert jdbc.key_range_predicates("c", ["a", "B", "c"])[1:3] == ["(c >= 'a' AND c < 'B')", "(c >= 'B' AND c < 'c')"]


def test_hash_slices_cover_every_row(spark, db):
    df = jdbc.hash_scan(spark, db, "big", "holes", 5)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 1000
    assert df.select("num").distinct().count() == 1000
    assert jdbc.hash_predicates(jdbc.Database("u"), "MATNR", 2) == [
        "(MOD(ABS(HASH(MATNR)), 2) = 0 OR MATNR IS NULL)", "(MOD(ABS(HASH(MATNR)), 2) = 1)",
    ]


def test_text_key_ranges(spark, db):
    predicates = jdbc.key_range_predicates('"code"', ["K0300", "K0600", "K0600"])
    df = jdbc.predicate_scan(spark, db, "big", predicates)
    assert df.rdd.getNumPartitions() == 3 and df.select("num").distinct().count() == df.count() == 1000
    assert jdbc.key_range_predicates("c", []) == ["1 = 1"]


def test_incremental_filter_reaches_the_database(spark, db):
    df = jdbc.scan(spark, db, "big", "num", 4).filter("num > 990")
    assert "PushedFilters: [*IsNotNull(num), *GreaterThan(num,990)]" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 9
    predicate = jdbc.incremental_predicate(db, "ts", "2024-01-01 16:30:00")
    assert jdbc.scan(spark, db, "big", "num", 4, predicate).count() == 9
    assert jdbc.incremental_predicate(db, "ts", None) is None
    assert jdbc.incremental_predicate(jdbc.Database("u"), "C", "2024-01-01 00:00:00") == "C > TIMESTAMP '2024-01-01 00:00:00'"


def test_empty_bounds(spark, db):
    with pytest.raises(jdbc.EmptySource):
        jdbc.bounds(spark, db, "big", "num", '"num" < 0')
    assert jdbc.scan(spark, db, "big", "num", 4, '"num" < 0').count() == 0


def test_upsert_twice(spark, db):
    base = spark.range(10).selectExpr("id as k", "'old' as v")
    sink_jdbc.write_table(base, db, "ups")
    delta = spark.range(5, 15).selectExpr("id as k", "'new' as v")
    for _ in range(2):
        sink_jdbc.upsert_table(delta, db, "ups", ["k"])
    found = {r[0]: r[1] for r in jdbc.single_scan(spark, db, "ups").collect()}
    assert found == {**{i: "old" for i in range(5)}, **{i: "new" for i in range(5, 15)}}


def test_merge_text_of_keys_alone():
    text = sink_jdbc.merge_statement(jdbc.Database("u"), "t", "s", ["a", "b"], ["a", "b"])
    assert "MATCHED THEN UPDATE" not in text and "NOT MATCHED THEN INSERT (a, b)" in text


def test_csv_round_trip(spark, folder):
    source = shaped.materials(spark, SMALL)
    files.write_csv_extract(source, f"{folder}/csv")
    back = files.csv_extract(spark, f"{folder}/csv", MATERIAL)
    assert back.exceptAll(source).count() == source.exceptAll(back).count() == 0


def test_plain_csv_has_blank_flags(spark, tmp_path):
    path = tmp_path / "lfa1.csv"
    path.write_text("MANDT,LIFNR,NAME1,LAND1,STCD1,STCD2,ERDAT,LOEVM\n001,0000000007,Acme,US,123456789,,20120101,\n")
    row = normalise(files.csv_extract(spark, str(path), VENDOR), VENDOR).first()
    assert row["vendor_number"] == "7" and row["is_deletion_flag"] is False and row["tax_number_2"] == ""


def test_extract_writes_sidecars_without_a_second_scan(spark, folder):
    written = sink_files.write_extract(shaped.materials(spark, SMALL), MATERIAL, folder, AT)
    assert written.rows == files.batch(spark, written.path).count()
    assert written.watermark == files.batch(spark, written.path).agg(F.max("LAEDA")).first()[0]
    stored = spark.read.json(f"{folder}/_manifest").first()
    assert stored["row_count"] == written.rows and stored["partition_num_chunks"] == 32
    assert "MATNR" in spark.read.text(f"{folder}/_schema").first()[0]
    again = sink_files.write_extract(shaped.materials(spark, SMALL), MATERIAL, folder, AT)
    assert files.batch(spark, again.path).count() == written.rows


def test_layouts(spark, folder):
    df = with_load_audit(normalise(shaped.price_history(spark, SMALL), PRICE_HISTORY), PRICE_HISTORY, "b", AT)
    sink_files.write_keyed(df, PRICE_HISTORY, f"{folder}/keyed", partitions=4)
    ranges = spark.read.parquet(f"{folder}/keyed").groupBy(F.input_file_name()).agg(
        F.min("material_number").alias("lo"), F.max("material_number").alias("hi")
    ).orderBy("lo").collect()
    assert len(ranges) == 4 and all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))
    sink_files.write_hourly(shaped.change_feed(spark, SMALL), "_dms_committed_at", f"{folder}/hourly")
    back = spark.read.parquet(f"{folder}/hourly")
    assert back.filter("dt <> date_format(_dms_committed_at, 'yyyy-MM-dd')").count() == 0
    assert back.count() == shaped.change_feed(spark, SMALL).count()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    df = normalise(shaped.vendors(spark, SMALL), VENDOR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("vend_a", "vend_b"):
            spark.sql(f"drop table if exists {name}")
            sink_files.save_bucketed(df, VENDOR, name, buckets=4)
        joined = spark.table("vend_a").join(spark.table("vend_b"), "vendor_number")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("vend_a", "vend_b"):
            spark.sql(f"drop table if exists {name}")


def test_text_keys_and_negative_keys(spark):
    db = jdbc.derby("keys")
    rows = spark.range(-60, 60).selectExpr("id as K", "concat('key-', lpad(cast(id + 60 as string), 4, '0')) as NAME").unionByName(
        spark.sql("select 999L as K, cast(null as string) as NAME"))
    sink_jdbc.write_table(rows, db, "keyed")
    assert jdbc.hash_scan(spark, db, "keyed", "K", 4).count() == 121
    by_name = jdbc.scan(spark, db, "keyed", "NAME", 4)
    assert by_name.count() == 121
    sizes = [r["n"] for r in by_name.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) <= 32
    assert jdbc.scan(spark, db, "keyed", "NAME", 4, '"K" > 1000').count() == 0
