"""Bronze from change files whose columns are not known beforehand.

The contract says which columns bronze has. What else the files hold is found in their footers and kept, as text, in a map beside
the row, so nothing is lost until the contract declares it. No schema is widened by hand.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import Contract
from plumbline.session import path_exists, read_text, write_text
from plumbline.streaming.cdc import batch_name, feed_schema

RESCUED = "_rescued"
FILE = "_cdc_source_file"


def columns_of_files(spark: SparkSession, files: list[str]) -> list[T.StructField]:
    """The columns that any of these Parquet files has. Footers are read by a Spark job; rows are not."""
    return spark.read.option("mergeSchema", "true").parquet(*files).schema.fields


class EvolvingFeed:
    """Change files to bronze, by one checkpoint. One run at a time."""

    def __init__(self, spark: SparkSession, feed_dir: str, bronze_dir: str, checkpoint: str, max_files: int = 1000):
        """max_files: how many files one micro-batch takes at most; their names are collected."""
        self.spark, self.feed_dir, self.bronze_dir, self.checkpoint, self.max_files = spark, feed_dir, bronze_dir, checkpoint, max_files

    @property
    def _memory(self) -> str:
        return f"{self.checkpoint}/columns.json"

    def found(self) -> list[T.StructField]:
        """Columns seen in files so far, with the types of the files that had them first."""
        if not path_exists(self.spark, self._memory):
            return []
        return T.StructType.fromJson(json.loads(read_text(self.spark, self._memory))).fields

    def ingest(self, contract: Contract, stored: dict[str, T.DataType] | None = None) -> None:
        """Take in all new files; ends when caught up.

        Each micro-batch is written to a folder of its own. The footers of its files are then read; if one has a column that was not
        read, the column is remembered, the micro-batch is not committed, and the stream starts again with the wider schema, which
        replaces that folder. A column that two files hold in types that cannot be merged stops the stream.
        """
        declared = feed_schema(contract, stored)
        while True:
            known = self.found()
            try:
                self._start(declared, known)
                return
            except StreamingQueryException:
                if len(self.found()) == len(known):
                    raise

    def _start(self, declared: T.StructType, known: list[T.StructField]) -> None:
        taken = {f.name.lower() for f in declared.fields}
        extra = [f for f in known if f.name.lower() not in taken]
        schema = T.StructType([*declared.fields, *extra])
        seen = {f.name.lower() for f in schema.fields}

        def write(batch: DataFrame, batch_id: int) -> None:
            folder = f"{self.bronze_dir}/batch={batch_name(self.spark, f'{self.checkpoint}/bronze', batch_id)}"
            batch.withColumn("_cdc_ingested_at", F.current_timestamp()).write.mode("overwrite").parquet(folder)
            names = [unquote(r[0]) for r in self.spark.read.parquet(folder).select(FILE).distinct().collect()]
            fresh = [f for f in columns_of_files(self.spark, names) if f.name.lower() not in seen] if names else []
            if fresh:
                self._remember([*known, *fresh])
                raise ValueError(f"new columns in the feed: {', '.join(f.name for f in fresh)}")

        rows = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.max_files).parquet(self.feed_dir)
        kept = rows.select(*[F.col(f"`{f.name}`") for f in declared.fields], rescued(extra).alias(RESCUED), F.col("_metadata.file_path").alias(FILE))
        kept.writeStream.foreachBatch(write).option("checkpointLocation", f"{self.checkpoint}/bronze").trigger(
            availableNow=True).start().awaitTermination()

    def _remember(self, fields: list[T.StructField]) -> None:
        write_text(self.spark, self._memory, T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json())

    def read(self, contract: Contract, stored: dict[str, T.DataType] | None = None) -> DataFrame:
        """Bronze under a contract. Rows that came before it declared a column have NULL there, and the value in the map."""
        schema = T.StructType([
            *feed_schema(contract, stored).fields, T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType())),
            T.StructField(FILE, T.StringType()), T.StructField("_cdc_ingested_at", T.TimestampType()),
        ])
        return self.spark.read.schema(schema).parquet(f"{self.bronze_dir}/batch=*")


def rescued(columns: list[T.StructField]) -> Column:
    """Name -> text of the values that are not NULL; NULL if there are none."""
    kind = "map<string,string>"
    if not columns:
        return F.lit(None).cast(kind)
    entries = F.array(*[F.struct(F.lit(f.name), F.col(f"`{f.name}`").cast("string").alias("value")) for f in columns])
    held = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return F.when(F.size(held) > 0, held).cast(kind)


def with_rescued(bronze: DataFrame, *columns: str) -> DataFrame:
    """Columns that the contract declares by now, filled from the map where rows came before that. What cannot be read as declared stays NULL."""
    kinds = {f.name: f.dataType for f in bronze.schema.fields}
    return bronze.withColumns({c: F.coalesce(F.col(c), F.col(RESCUED)[c].try_cast(kinds[c])) for c in columns})
