from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ledger, monitor
from plumbline.sinks.ledger import Ledger

T0 = datetime(2024, 1, 1)


def test_batch_life(spark, folder):
    book = Ledger(spark, f"{folder}/ledger")
    assert book.watermark("j", "t") is None and not book.is_processed("j", "b1")
    assert book.start("j", "b1", at=T0)
    assert not book.start("j", "b1", at=T0 + timedelta(minutes=1))
    book.fail("j", "b1", "x" * 2000, at=T0 + timedelta(minutes=2))
    assert book.start("j", "b1", at=T0 + timedelta(minutes=3))
    book.succeed("j", "b1", 42, at=T0 + timedelta(minutes=4))
    assert book.is_processed("j", "b1") and not book.start("j", "b1")
    assert not book.is_processed("other", "b1")
    item = ledger.batch_items(book.entries()).first()
    assert (item["status"], item["row_count"]) == ("SUCCEEDED", 42)
    assert item["started_at"] == T0 + timedelta(minutes=3) and item["completed_at"] == T0 + timedelta(minutes=4)
    assert max(len(r["error_message"] or "") for r in book.entries().collect()) == 1000


def test_watermarks_and_expiry(spark, folder):
    book = Ledger(spark, f"{folder}/ledger")
    book.set_watermark("j", "t", "1", at=T0)
    book.set_watermark("j", "t", "2", at=T0 + timedelta(days=1))
    book.start("j", "old", at=T0)
    book.start("j", "new", at=T0 + timedelta(days=40))
    assert book.watermark("j", "t") == "2"
    kept = book.expire(T0 + timedelta(days=45), f"{folder}/compact")
    assert kept.watermark("j", "t") == "2"
    assert {r["name"] for r in kept.entries().filter("kind = 'batch'").collect()} == {"new"}
    stuck = ledger.stuck(book.entries(), T0 + timedelta(days=40, hours=1))
    assert {r["name"] for r in stuck.collect()} == {"old"}
    assert ledger.with_prefix(book.entries(), "batch#j#n").count() == 1


def test_work_lists(spark, folder):
    book = Ledger(spark, f"{folder}/ledger")
    book.start("j", "running")
    book.start("j", "failed")
    book.fail("j", "failed", "no")
    book.start("j", "done")
    book.succeed("j", "done")
    work = spark.createDataFrame([("j", n) for n in ("running", "failed", "done", "fresh")], "job string, name string")
    assert {r["name"] for r in ledger.to_process(work, book.entries()).collect()} == {"running", "failed", "fresh"}
    assert {r["name"] for r in ledger.startable(work, book.entries()).collect()} == {"failed", "fresh"}


def test_unconsumed(spark):
    queue = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "request int, row string")
    consumed = spark.createDataFrame([(1,), (1,)], "request int")
    assert [r["row"] for r in ledger.unconsumed(queue, consumed, "request").collect()] == ["c"]


def test_streaks(spark):
    days = [(date(2024, 1, d), d not in (3, 7)) for d in range(1, 11) if d != 9]
    nights = spark.createDataFrame([("t", *d) for d in days], "t string, day date, green boolean")
    streaks = {(r["first_day"].day, r["last_day"].day, r["nights"]) for r in monitor.green_streaks(nights, "t", "day", "green").collect()}
    # Day 9 is missing, so the run breaks there.
    assert streaks == {(1, 2, 2), (4, 6, 3), (8, 8, 1), (10, 10, 1)}
    gate = monitor.streak_gate(nights, "t", "day", "green", needed=2).first()
    assert gate["green_nights"] == 1 and not gate["gate_open"]


def test_streak_gate_of_a_red_last_night(spark):
    nights = spark.createDataFrame([("t", date(2024, 1, 1), True), ("t", date(2024, 1, 2), False)], "t string, day date, green boolean")
    assert monitor.streak_gate(nights, "t", "day", "green").first()["green_nights"] == 0


def test_diff_rate_gate(spark):
    def gate(days):
        df = spark.createDataFrame([("t", date(2024, 1, d), 100000, m) for d, m in days], "t string, day date, q long, m long")
        return monitor.diff_rate_gate(df, "t", "day", "q", "m").first()["gate_open"]

    good = [(d, 1) for d in range(1, 16)]
    assert gate(good)
    assert gate([(1, 500), *good[1:]])
    assert not gate([*good[:-1], (15, 500)])
    assert not gate(good[:5])


def lag_rows(spark, values):
    rows = [("t", T0 + timedelta(minutes=m, seconds=5), float(v)) for m, v in values]
    return spark.createDataFrame(rows, "t string, ts timestamp, lag double")


@pytest.mark.parametrize("values, alarms", [
    ([(0, 61), (1, 70), (2, 61)], [2]),
    ([(0, 61), (1, 70), (2, 60)], []),
    ([(0, 61), (1, 70), (3, 99)], []),
    ([(0, 61), (1, 70), (2, 61), (3, 65)], [2, 3]),
])
def test_lag_alarm(spark, values, alarms):
    found = monitor.consecutive_breaches(lag_rows(spark, values), "ts", ["t"], "lag")
    assert sorted((r["period_start"] - T0).seconds // 60 for r in found.collect()) == alarms


def test_threshold_alarms(spark):
    df = spark.createDataFrame(
        [(T0, 1.0, "OK"), (T0 + timedelta(minutes=6), 1.1, "FAILED")], "ts timestamp, drift double, status string"
    )
    assert [r["measure"] for r in monitor.drift_alarm(df, "ts", [], "drift").collect()] == [1.1]
    assert [r["measure"] for r in monitor.failure_alarm(df, "ts", [], F.col("status") == "FAILED").collect()] == [1]


def test_throughput(spark):
    df = spark.createDataFrame(
        [("j", T0, T0 + timedelta(seconds=100), 50), ("j", T0, T0 + timedelta(seconds=100), 25), ("j", T0, T0, 0)],
        "job string, started_at timestamp, completed_at timestamp, row_count long",
    )
    row = monitor.throughput_trend(df).first()
    assert (row["n_runs"], row["avg_seconds_per_row"]) == (2, 3.0)


@pytest.mark.parametrize("path, expected", [
    ("cdc/sap/MARA/2024/01/01/00/x.parquet", "MARA"), ("cdc/sap/MARA", "MARA"), ("raw/sap/MARA/x", None), ("cdc", None), ("cdc/x/MARA", None),
])
def test_table_of_path(spark, path, expected):
    assert spark.range(1).select(monitor.table_of_path(F.lit(path))).first()[0] == expected


def test_latest_run(spark):
    runs = spark.createDataFrame(
        [("c", "20240101", "120000", "R"), ("c", "20240102", "080000", "R"), ("c", "20240102", "090000", "G"), ("x", "20250101", "0", "R")],
        "chain_id string, d string, t string, status string",
    )
    monitor.require_green(runs, "c", ["d", "t"])
    with pytest.raises(RuntimeError, match="not 'G'"):
        monitor.require_green(runs, "x", ["d", "t"])
    with pytest.raises(RuntimeError, match="never run"):
        monitor.require_green(runs, "nope", ["d", "t"])
