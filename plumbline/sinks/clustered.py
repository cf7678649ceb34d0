"""Tables clustered by several columns at once, so that a filter on any of them opens few files.

Each column is cut into cells of about as many rows. The bits of a row's cells, interleaved, give one number; rows are laid out
in its order. Files then hold small boxes of the columns' values, and Parquet's own statistics leave files out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

CLUSTER = "_cluster"
BITS = 6


def cell_bounds(df: DataFrame, column: str, bits: int = BITS) -> list:
    """The least value of each cell but the first, of at most 2^bits cells. One shuffle of this column alone; a value is in one cell.

    Spark's range partitioning finds the bounds, for any type that can be ordered.
    """
    cells = df.select(F.col(column).alias("v")).filter("v is not null").repartitionByRange(2 ** bits, "v")
    bounds = cells.groupBy(F.spark_partition_id().alias("cell")).agg(F.min("v").alias("low")).orderBy("low").collect()
    return [r["low"] for r in bounds[1:]]


def cell_of(column: Column, bounds: list) -> Column:
    """The cell a value falls in, from 0. NULL falls in the first, as it is sorted first."""
    if not bounds:
        return F.lit(0)
    passed = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= column)
    return F.when(column.isNull(), 0).otherwise(F.size(passed))


def interleaved(cells: list[Column], bits: int = BITS) -> Column:
    """The bits of several cells in turn, the highest ones first. The first column's bit is the higher one."""
    n = len(cells)
    if n * bits > 62:
        raise ValueError(f"{n} columns of {bits} bits do not fit a long")
    number = F.lit(0).cast("long")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            part = F.shiftright(cell.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            number = number + F.shiftleft(part, bit * n + n - 1 - i)
    return number


def write_clustered(df: DataFrame, columns: list[str], path: str, files: int, bits: int = BITS) -> None:
    """The table in about so many files of about as many rows, clustered by the columns. The number is kept as ``_cluster``.

    Rows of one number are split by the columns' own order, so a crowded cell becomes several files. Only rows that agree in all
    columns are bound to one file.
    """
    cells = [cell_of(F.col(c), cell_bounds(df, c, bits)) for c in columns]
    placed = df.withColumn(CLUSTER, interleaved(cells, bits))
    order = [CLUSTER, *columns]
    placed.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def file_ranges(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row per file: its rows, the least and greatest value of each column, and its least and greatest place in the order."""
    stored = spark.read.parquet(path)
    place = F.struct(CLUSTER, *columns)
    ranges = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("greatest", F.max))]
    return stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(place).alias("first"), F.max(place).alias("last"), *ranges)


def overlaps(ranges: DataFrame) -> DataFrame:
    """Files whose places reach into those of the next file; none in a table written at once. There is one row per file to order."""
    following = F.lead("first").over(Window.orderBy("first", "last"))
    return ranges.withColumn("next_first", following).filter(F.col("next_first") <= F.col("last"))


def files_for(ranges: DataFrame, column: str, low, high) -> DataFrame:
    """The files that may hold values from low to high of a column."""
    return ranges.filter((F.col(f"greatest_{column}") >= F.lit(low)) & (F.col(f"least_{column}") <= F.lit(high)))
