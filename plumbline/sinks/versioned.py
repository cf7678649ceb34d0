"""A keyed Parquet table with merge, replay protection and restore.

Rows are spread over hash buckets of the key. A commit rewrites only the buckets it touches, into a
new folder, and appends one small log file that says which folder is now current for which bucket.
Readers follow the log, so a half-written commit is never seen, and an old version is restored by
logging its folders again. One writer per table is assumed. The keys and the number of buckets are stored
with the table; it cannot be written with others.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.digest import key_bucket
from plumbline.operators.merge import apply_changes, delete_insert, undo_batch, upsert
from plumbline.session import path_exists, read_text, write_text

LOG_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("folder", T.LongType()),
    T.StructField("batch", T.StringType()),
    # What a commit takes back: every commit after a version, or the rows of one batch.
    T.StructField("restored", T.LongType()),
    T.StructField("removed", T.StringType()),
])
KEY_TEXT = "utc-1"
BUCKET = "_bucket"


@dataclass(frozen=True)
class Snapshot:
    version: int
    live: dict[int, int]
    """Bucket -> folder that holds its rows."""
    has_batch: bool = False


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 16, from_files: bool = False):
        """from_files: changes are read from files and are the same rows whenever they are computed."""
        self.spark = spark
        self.path = path.rstrip("/")
        # Files may lack any column, so everything is read as nullable.
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.keys = keys
        self.buckets = buckets
        self.from_files = from_files

    @property
    def _layout(self) -> dict:
        return {"keys": list(self.keys), "buckets": self.buckets, "key_text": KEY_TEXT}

    def _hold_layout(self) -> None:
        """Before rows are placed: the table's layout must be this one. The first commit stores it."""
        path = f"{self.path}/layout.json"
        if not path_exists(self.spark, path):
            write_text(self.spark, path, json.dumps(self._layout))
        elif (stored := json.loads(read_text(self.spark, path))) != self._layout:
            raise ValueError(f"{self.path} is laid out by {stored}, not by {self._layout}")

    def log(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/log"):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/log")

    def snapshot(self, version: int | None = None, batch: str | None = None) -> Snapshot:
        """State of the log at a version: one row per bucket collected, and the commits that concern the batch.

        A batch counts as seen only while no later commit has taken it back.
        """
        log = self.log()
        batch_id = F.lit(batch).cast("string")
        if version is not None:
            log = log.filter(F.col("version") <= version)
        concerned = (F.col("batch") == batch_id) | (F.col("removed") == batch_id) | F.col("restored").isNotNull()
        rows = log.groupBy("bucket").agg(
            F.max_by("folder", "version").alias("folder"),
            F.max("version").alias("version"),
            F.collect_set(F.when(concerned, F.struct("version", "batch", "restored", "removed"))).alias("commits"),
        ).collect()
        seen = None
        if batch is not None:
            for r in sorted({c for r in rows for c in r["commits"]}, key=lambda c: c["version"]):
                if r["batch"] == batch:
                    seen = r["version"]
                elif seen is not None and (r["removed"] == batch or (r["restored"] is not None and r["restored"] < seen)):
                    seen = None
        return Snapshot(
            version=max((r["version"] for r in rows), default=0),
            live={r["bucket"]: r["folder"] for r in rows if r["bucket"] is not None and r["folder"] is not None},
            has_batch=seen is not None,
        )

    def version(self) -> int:
        return self.snapshot().version

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.snapshot(version).live)

    def _rows(self, live: dict[int, int]) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], self.schema)
        by_folder: dict[int, list[int]] = {}
        for bucket, folder in live.items():
            by_folder.setdefault(folder, []).append(bucket)
        parts = []
        for folder, members in sorted(by_folder.items()):
            stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
            part = self.spark.read.schema(stored).parquet(f"{self.path}/data/v={folder}")
            parts.append(part.filter(F.col(BUCKET).isin(members)).drop(BUCKET))
        return reduce(DataFrame.unionByName, parts)

    def written(self, version: int | None) -> DataFrame:
        """The rows of the buckets that one commit rewrote; none without a version."""
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/v={version}")

    def _commit(self, df: DataFrame, batch: str, version: int, touched: list[int], removed: str | None = None) -> int:
        """Write the full new content of the touched buckets and log it."""
        rows = df.select(*self.schema.names).withColumn(BUCKET, key_bucket(df, self.keys, self.buckets))
        # Rebalance puts a bucket's rows together, and cuts large buckets into several files.
        rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.path}/data/v={version}"
        )
        self._append_log([(version, b, version, batch, None, removed) for b in touched])
        return version

    def _append_log(self, rows: list[tuple]) -> None:
        lines = [json.dumps(dict(zip(LOG_SCHEMA.names, r))) for r in rows]
        write_text(self.spark, f"{self.path}/log/{rows[0][0]:012d}-{uuid.uuid4().hex[:8]}.json", "\n".join(lines) + "\n")

    def _touched(self, df: DataFrame) -> list[int]:
        """Buckets of the given rows; at most one value per bucket."""
        bucket = key_bucket(df, self.keys, self.buckets).alias(BUCKET)
        return [r[0] for r in df.select(bucket).distinct().collect()]

    def _staged(self, changes: DataFrame) -> DataFrame:
        """The changes, written once: which buckets they touch and what goes there must be the same rows."""
        path = f"{self.path}/staged/{uuid.uuid4().hex}"
        changes.write.parquet(path)
        return self.spark.read.schema(changes.schema).parquet(path)

    def _rewrite(self, changes: DataFrame, batch: str, change, removed: str | None = None, staged: bool = False) -> int | None:
        self._hold_layout()
        now = self.snapshot(batch=batch)
        if now.has_batch:
            return None
        if not staged and not self.from_files:
            changes = self._staged(changes)
        touched = self._touched(changes)
        if not touched:
            self._append_log([(now.version + 1, None, None, batch, None, removed)])
            return None
        old = self._rows({b: f for b, f in now.live.items() if b in set(touched)})
        return self._commit(change(old, changes), batch, now.version + 1, touched, removed)

    def apply(self, versions: DataFrame, order: list[str], batch: str, staged: bool = False) -> int | None:
        """Keep the newest version per key. A batch that was already applied is skipped.

        ``staged`` says that these changes are read from files.
        """
        return self._rewrite(versions, batch, lambda old, new: apply_changes(old, new, self.keys, order), staged=staged)

    def upsert(self, rows: DataFrame, batch: str, order: list[str] | None = None) -> int | None:
        """A batch that is in the table already is skipped."""
        return self._rewrite(rows, batch, lambda old, new: upsert(old, new, self.keys, order))

    def delete_insert(self, rows: DataFrame, batch: str) -> int | None:
        return self._rewrite(rows, batch, lambda old, new: delete_insert(old, new, self.keys))

    def delete_batch(self, batch_id: str, batch: str) -> int | None:
        """Remove the rows of one load. The load may then come again."""
        mine = F.col("_batch_id").eqNullSafe(F.lit(batch_id))
        return self._rewrite(self.read().filter(mine), batch, lambda old, _: old.filter(~mine), removed=batch_id, staged=True)

    def undo_batch(self, batch_id: str, batch: str) -> int | None:
        """Remove the rows of one load, and put back those that it had replaced. The load may then come again.

        The load's commit is the last one named like it, or like it with the mark of an attempt (``#`` and eight characters).
        """
        attempt = F.col("batch").startswith(f"{batch_id}#") & (F.length("batch") == len(batch_id) + 9)
        loaded = self.log().filter((F.col("batch") == batch_id) | attempt).agg(F.max("version")).first()[0] or 1
        mine = self.read().filter(F.col("_batch_id").eqNullSafe(F.lit(batch_id)))
        touched = set(self._touched(mine))
        before = self._rows({b: f for b, f in self.snapshot(loaded - 1).live.items() if b in touched})
        return self._rewrite(mine, batch, lambda old, _: undo_batch(old, before, self.keys, batch_id), removed=batch_id, staged=True)

    def restore(self, version: int, batch: str) -> int:
        """Make an older version current again. Buckets it did not have become empty."""
        then, now = self.snapshot(version), self.snapshot()
        new = now.version + 1
        self._append_log([(new, b, then.live.get(b), batch, version, None) for b in sorted(set(then.live) | set(now.live))])
        return new
