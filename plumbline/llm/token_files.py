"""Token ids in Arrow files of equal-length sequences, with random access and no copying.

A file is one range of documents in order. Their ids follow each other without gaps, cut into rows
of one length: a column of ids and a column of masks, both fixed-size lists, the last row padded.
Ids are unsigned 16-bit numbers where the vocabulary allows, else 32-bit. A file is not compressed,
so a reader maps it and takes any sequence, or any document, as a view of the mapped bytes.

Files are written under a name of their own and then moved, so a task that runs twice leaves one file. The
index (document, file, place in the file, length) is a Parquet table.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import stored
from plumbline.llm.tokens import encoder
from plumbline.session import scratch_dir

LENGTH = 2048
ROWS = 256
FILE_BYTES = 64 << 20
# A worker that does nothing but encode has room for more pieces than one that packs.
PIECES_KEPT = 300_000


def file_schema(kind: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Takes ids in order and writes full batches of equal-length rows."""

    def __init__(self, sink, kind: pa.DataType, length: int, rows: int):
        self.kind, self.length, self.rows = kind, length, rows
        self.writer = pa.ipc.new_file(sink, file_schema(kind, length))
        self.waiting, self.n = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n += len(ids)
        if self.n >= self.length * self.rows:
            self._write(self.n - self.n % (self.length * self.rows))

    def _write(self, upto: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind.to_pandas_dtype())
        step = self.length * self.rows
        for lo in range(0, upto, step):
            part = ids[lo:min(upto, lo + step)]
            self._batch(part, len(part))
        self.waiting, self.n = [ids[upto:]], self.n - upto

    def _batch(self, ids: np.ndarray, real: int) -> None:
        width = -(-len(ids) // self.length) * self.length
        ids = np.pad(ids, (0, width - len(ids)))
        mask = np.arange(width) < real
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)],
            schema=file_schema(self.kind, self.length)))

    def close(self) -> None:
        self._write(self.n)
        self.writer.close()


class SequenceReader:
    """Views of a file's ids: nothing is copied unless a range crosses batches."""

    def __init__(self, source):
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batches: dict[int, np.ndarray] = {}
        self.batch_ids = self.file.get_batch(0).num_rows * self.length if self.file.num_record_batches else 1

    def _ids(self, i: int) -> np.ndarray:
        if i not in self.batches:
            if len(self.batches) > 4:
                self.batches.clear()
            self.batches[i] = self.file.get_batch(i).column("ids").values.to_numpy(zero_copy_only=True)
        return self.batches[i]

    def sequence(self, row: int) -> np.ndarray:
        return self.ids(row * self.length, self.length)

    def mask(self, row: int) -> np.ndarray:
        batch, place = divmod(row * self.length, self.batch_ids)
        values = self.file.get_batch(batch).column("mask").values
        return values.slice(place, self.length).to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        batch, place = divmod(start, self.batch_ids)
        parts = []
        while n > 0:
            part = self._ids(batch)[place:place + n]
            parts.append(part)
            n -= len(part)
            batch, place = batch + 1, 0
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(root: str, tokenizer: str, end_id: int, length: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, folder = _store(root)
        encode = encoder(tokenizer, PIECES_KEPT)
        kind = pa.uint16() if max(encode.vocabulary, end_id + 1) <= 1 << 16 else pa.uint32()
        end = np.array([end_id], kind.to_pandas_dtype())
        name, mine = f"{task.partitionId():07d}.arrow", f".{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        writer, at = None, 0
        for batch in batches:
            starts, lengths = [], []
            if writer is None and batch.num_rows:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(f"{folder}/{mine}")
                writer = SequenceWriter(sink, kind, length, rows)
            for text in batch.column(1):
                ids = np.r_[np.frombuffer(encode.encode(text.as_py() or ""), "<u4").astype(end.dtype), end]
                writer.add(ids)
                starts.append(at)
                lengths.append(len(ids))
                at += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([name] * batch.num_rows, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                names=["doc_id", "file", "at", "n_tokens"])
        if writer is not None:
            writer.close()
            sink.close()
            store.move(f"{folder}/{mine}", f"{folder}/{name}")

    return run


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      length: int = LENGTH, rows: int = ROWS, files: int | None = None) -> DataFrame:
    """Writes all texts in ascending order of id below root, and gives the index: doc_id, file, at, n_tokens.

    A null text is empty and gives the end id alone. Null ids come first; rows of one id follow each
    other by text. Other columns are not read. An empty table writes no file. root is a URI that
    driver and executors share.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if files is None:
        size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    order = ["doc_id", F.xxhash64("text"), "text"]
    index = (source.repartitionByRange(files, *order[:2]).sortWithinPartitions(*order)
             .mapInArrow(_write(root, tokenizer, end_id, length, rows), "doc_id long, file string, at long, n_tokens long"))
    return stored(index, "token-index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with `start`, the ids of all documents before. There is one total for each file to add up."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    return index.join(files, "file").withColumn("start", F.col("base") + F.col("at")).drop("base")


def _checksums(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(root)
        name, reader, source = None, None, None
        for batch in batches:
            found = []
            for file, at, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if file != name:
                    if source is not None:
                        source.close()
                    path = f"{folder}/{file}"
                    source = pa.memory_map(path) if store.type_name == "local" else store.open_input_file(path)
                    name, reader = file, SequenceReader(source)
                found.append(zlib.crc32(reader.ids(at, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "ids_crc32"])

    return run


def read_checksums(index: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    spark = index.sparkSession
    rows = with_starts(index).select("doc_id", "file", "at", "n_tokens", "start")
    return (rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").sortWithinPartitions("file", "at")
            .mapInArrow(_checksums(root), "doc_id long, file string, at long, n_tokens long, start long, ids_crc32 long")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


def token_root(spark: SparkSession) -> str:
    return scratch_dir(spark, "token-files")
