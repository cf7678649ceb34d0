"""A request queue read by a pointer that moves with the load.

Every load has a number. What it is to read, from the request after the last load's to the newest one there is, is written down
before anything is read; that it is done, after its rows are written. A load that was cut short is found by its plan without a
commit, and done again: the same requests, into the same folder. So every request is loaded once, whatever happens in between.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import path_exists, read_text, write_text


@dataclass(frozen=True)
class Load:
    number: int
    after: object
    """The request that the load before ended with; None for the first."""
    up_to: object


class QueueReader:
    """One reader of a queue. Requests are numbers or texts that only grow; one reader at a time is assumed."""

    def __init__(self, spark: SparkSession, path: str, request: str):
        self.spark, self.path, self.request = spark, path.rstrip("/"), request

    def _plan(self, number: int) -> str:
        return f"{self.path}/plans/{number:08d}.json"

    def _commit(self, number: int) -> str:
        return f"{self.path}/commits/{number:08d}.json"

    def _read(self, number: int) -> Load | None:
        if not path_exists(self.spark, self._plan(number)):
            return None
        return Load(**json.loads(read_text(self.spark, self._plan(number))))

    def committed(self) -> int:
        """Number of the last load that is done, 0 before the first."""
        pointer = f"{self.path}/pointer.json"
        number = json.loads(read_text(self.spark, pointer))["number"] if path_exists(self.spark, pointer) else 0
        # The pointer file only shortens the way: the commits decide.
        while path_exists(self.spark, self._commit(number + 1)):
            number += 1
        return number

    def next_load(self, queue: DataFrame) -> Load | None:
        """The load that was cut short, or else a new one of all requests after the pointer; None if there are none."""
        done = self.committed()
        if (open_load := self._read(done + 1)) is not None:
            return open_load
        after = self._read(done).up_to if done else None
        waiting = queue if after is None else queue.filter(F.col(self.request) > F.lit(after))
        newest = waiting.agg(F.max(self.request)).first()[0]
        if newest is None:
            return None
        load = Load(done + 1, after, newest)
        write_text(self.spark, self._plan(load.number), json.dumps(load.__dict__))
        return load

    def rows_of(self, queue: DataFrame, load: Load) -> DataFrame:
        """The requests of one load; both bounds reach the scan as pushed filters."""
        rows = queue.filter(F.col(self.request) <= F.lit(load.up_to))
        return rows if load.after is None else rows.filter(F.col(self.request) > F.lit(load.after))

    def folder(self, number: int) -> str:
        return f"{self.path}/loads/{number:08d}"

    def consume(
        self, queue: DataFrame, ready: Callable[[], None] | None = None, write: Callable[[DataFrame, str], None] | None = None
    ) -> Load | None:
        """Load what is waiting, then move the pointer. Gives the load, or None if nothing waits.

        ready: raises if the queue's filler has not ended well; then nothing is read and nothing moves. write: stores the rows in the
        load's folder in place of what is there.
        """
        if ready is not None:
            ready()
        load = self.next_load(queue)
        if load is None:
            return None
        write = write or (lambda rows, folder: rows.write.mode("overwrite").parquet(folder))
        write(self.rows_of(queue, load), self.folder(load.number))
        write_text(self.spark, self._commit(load.number), json.dumps(load.__dict__))
        write_text(self.spark, f"{self.path}/pointer.json", json.dumps({"number": load.number}))
        return load

    def loaded(self, schema) -> DataFrame:
        """Rows of all loads that are done, with the load's number; what a load that was cut short has left is not seen."""
        folders = [self.folder(n) for n in range(1, self.committed() + 1)]
        if not folders:
            return self.spark.createDataFrame([], schema).withColumn("load", F.lit(None).cast("int"))
        rows = self.spark.read.schema(schema).parquet(*folders)
        return rows.withColumn("load", F.regexp_extract(F.col("_metadata.file_path"), r"/loads/(\d+)/", 1).cast("int"))
