"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, name: str = "plumbline") -> SparkSession:
    """Session for tests and benchmarks on one machine. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session may go without that setting and
    then gets a temporary folder.
    """
    root = _shared_root(spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def _shared_root(setting: str | None, master: str) -> str:
    if setting is not None:
        return setting
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="spark-plumbline-", dir="/tmp")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. The file system decides between two that try at once."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder, or a file; False if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an existing one is replaced."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
