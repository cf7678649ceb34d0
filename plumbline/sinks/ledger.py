"""Writer side of the run ledger: entries are appended, never changed.

All entries carry one clock, the writer's, and a sequence that decides between equal times. A batch is
started by creating a marker file that must not exist, so of two drivers one wins.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.ledger import (
    BATCH, ERROR_LENGTH, EXPIRY_DAYS, FAILED, ROLLED_BACK, SCHEMA, STARTED, SUCCEEDED, WATERMARK, latest_status, unexpired, watermarks,
)
from plumbline.session import create_file, delete_folder, path_exists, write_text

STORED = T.StructType([*SCHEMA.fields, T.StructField("seq", T.LongType())])
TIE = ["seq"]
# JSON keeps milliseconds alone if nothing else is said.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _batch(job: str, batch_id: str, status: str, at, row_count=None, error: str | None = None) -> tuple:
    return (BATCH, job, batch_id, status, at or _now(), row_count, error and error[:ERROR_LENGTH], None)


def _file_name(text: str) -> str:
    return quote(text, safe="")


def _mark(job: str, table: str, watermark: str | None, at) -> tuple:
    return (WATERMARK, job, table, None, at or _now(), None, None, watermark)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def entries(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).json(f"{self.path}/*")

    def _append(self, *rows: tuple) -> None:
        # A file per entry: runs of several tables may write at the same time.
        stamp = time.time_ns()
        entries = [dict(zip(STORED.names, (*row, stamp + i))) for i, row in enumerate(rows)]
        for entry in entries:
            entry["at"] = entry["at"].astimezone(timezone.utc).isoformat()
        write_text(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", "".join(json.dumps(e) + "\n" for e in entries))

    def _status(self, job: str, batch_id: str) -> str | None:
        mine = self.entries().filter((F.col("job") == job) & (F.col("name") == batch_id))
        row = latest_status(mine, TIE).first()
        return row and row["status"]

    def _state(self, job: str, batch_id: str) -> tuple[str | None, int]:
        """Latest status, and the attempts that are over: failed, or rolled back."""
        mine = (F.col("kind") == BATCH) & (F.col("job") == job) & (F.col("name") == batch_id)
        row = self.entries().filter(mine).agg(
            F.max_by("status", F.struct("at", "seq")).alias("status"),
            F.count_distinct(F.when(F.col("status").isin(FAILED, ROLLED_BACK), F.col("seq"))).alias("over")).first()
        return row["status"], row["over"]

    def is_processed(self, job: str, batch_id: str) -> bool:
        return self._status(job, batch_id) == SUCCEEDED

    def start(self, job: str, batch_id: str, at=None) -> bool:
        """False if the batch is under way or done."""
        status, over = self._state(job, batch_id)
        if status not in (None, FAILED, ROLLED_BACK):
            return False
        marker = f"{self.path}-starts/{_file_name(job)}/{_file_name(batch_id)}-{over}"
        if not create_file(self.spark, marker):
            return False
        self._append(_batch(job, batch_id, STARTED, at))
        return True

    def succeed(
        self, job: str, batch_id: str, row_count: int = 0, at=None, table: str | None = None, watermark: str | None = None
    ) -> None:
        """Note success and, in the same write, how far the table has been read."""
        rows = [_batch(job, batch_id, SUCCEEDED, at, row_count)]
        if watermark is not None:
            rows.append(_mark(job, table, watermark, at))
        self._append(*rows)

    def fail(self, job: str, batch_id: str, error: str, at=None) -> None:
        self._append(_batch(job, batch_id, FAILED, at, 0, error))

    def rolled_back(self, job: str, batch_id: str, table: str) -> str | None:
        """Note that a batch was taken back, and set the table's watermark to what it was before. Gives that watermark."""
        entries = self.entries().filter(F.col("job") == job)
        done = entries.filter((F.col("kind") == BATCH) & (F.col("name") == batch_id) & (F.col("status") == SUCCEEDED))
        row = done.agg(F.max(F.struct("at", "seq")).alias("t")).first()
        marks = entries.filter((F.col("kind") == WATERMARK) & (F.col("name") == table))
        before = None
        if row["t"] is not None:
            earlier = marks.filter(F.struct("at", "seq") < F.struct(F.lit(row["t"]["at"]), F.lit(row["t"]["seq"])))
            found = watermarks(earlier, F.col("seq")).first()
            before = found and found["watermark"]
        rows = [_batch(job, batch_id, ROLLED_BACK, None)]
        if not marks.isEmpty():
            rows.append(_mark(job, table, before, None))
        self._append(*rows)
        return before

    def watermark(self, job: str, table: str) -> str | None:
        mine = self.entries().filter((F.col("job") == job) & (F.col("name") == table))
        row = watermarks(mine, F.col("seq")).first()
        return row and row["watermark"]

    def set_watermark(self, job: str, table: str, value: str, at=None) -> None:
        self._append(_mark(job, table, value, at))

    def expire(self, now: datetime, into: str) -> "Ledger":
        """Compact without old batch entries, into a new folder."""
        unexpired(self.entries(), now).write.option("timestampFormat", MICROS).json(f"{into}/{uuid.uuid4().hex}")
        return Ledger(self.spark, into)

    def compact(self, now: datetime | None = None, days: int = EXPIRY_DAYS) -> None:
        """Put all entries into one file, without old batch entries if the time is given, and delete the files they came from.

        Entries written meanwhile are not touched. If it is cut short, entries may be there twice, which no question notices.
        """
        before = [f for f in self.entries().inputFiles()]
        if not before:
            return
        entries = self.spark.read.schema(STORED).json(before)
        if now is not None:
            entries = unexpired(entries, now, days)
        # Many tasks read, filter and encode; the one that writes the file is handed only the lines that stay.
        lines = entries.select(F.to_json(F.struct(*STORED.names), {"timestampFormat": MICROS}).alias("value"))
        lines.repartition(1).write.text(f"{self.path}/{uuid.uuid4().hex}")
        for file in before:
            delete_folder(self.spark, file)
