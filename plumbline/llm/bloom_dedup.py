"""Exact copies of texts, found by two passes of Bloom filtering. Built-in functions only.

1. Texts are read once. What is kept of a row is its id, a row number and the SHA-256 of the text with A-Z
   lower-cased; everything after works on these narrow rows.
2. First pass: every digest names CELLS cells of one block of a blocked Bloom filter, and the cells that
   two rows or more have hit are counted out. Tasks pre-aggregate, so a text that holds a third of all rows is one row of
   each task.
3. Second pass: those cells are the second filter, one bitmap a block. It goes to the tasks, which probe their own rows. A row
   with a cell that nothing else has hit cannot have a copy: it passes straight through and is never shuffled.
4. Only the possibly repeated rows meet by digest, which decides exactly.

The second filter has BITS bits a row. What is broadcast at once is at most FILTER_BYTES: more rows are worked off in
slices of the digest domain, one after the other, each with a filter of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ascii_lower, stored

CELLS = 3
BITS = 8
# Spark's bitmap functions work on bitmaps of this many bits.
BLOCK = 32768
FILTER_BYTES = 64 << 20
# A group that holds more than one in HOT of the possibly repeated rows is joined apart; there are fewer than HOT of them.
HOT = 1000


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty. Texts of ASCII alone take the quicker function, which does the same there."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(ascii_lower(text))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row, sha: one narrow stored row for each row of docs."""
    return stored(docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                              F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("sha")), "bloom-digests")


def _cell(j: int) -> Column:
    """The j-th place of a digest within its block."""
    return F.shiftrightunsigned(F.xxhash64("sha", F.lit(j)), 49).cast("int")


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(7)) == 1


def hit_twice(rows: DataFrame) -> DataFrame:
    """block, bitmap: the cells that two rows or more have hit, from rows with block and sha."""
    cells = rows.select("block", F.explode(F.array(*(_cell(j) for j in range(CELLS)))).alias("place"))
    twice = cells.groupBy("block", "place").count().where("count > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bitmap"))


def possibly_repeated(rows: DataFrame, second: DataFrame) -> DataFrame:
    """The rows with a column `again`: false only where no other row has the digest."""
    bits = F.lit(True)
    for j in range(CELLS):
        bits = bits & _bit(F.col("bitmap"), _cell(j))
    return rows.join(F.broadcast(second), "block", "left").withColumn("again", F.coalesce(bits, F.lit(False))).drop("bitmap")


def _decided(rows: DataFrame) -> DataFrame:
    """Rows with their group's kept row and size. rows: id, row, sha, stored."""
    groups = rows.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size"))
    groups = stored(groups, "bloom-groups")
    is_hot = F.col("group_size") > rows.count() / HOT
    hot = groups.where(is_hot)
    # The few large groups are looked up where their rows are; the others are small, so no task gets many rows of one key.
    large = rows.join(F.broadcast(hot), "sha")
    small = rows.join(F.broadcast(hot.select("sha")), "sha", "left_anti").join(groups.where(~is_hot), "sha")
    return large.unionByName(small).select("id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("keep.row") == F.col("row")).alias("kept"), "sha")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = FILTER_BYTES, bits: int = BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each input row.

    Texts are equal if they are identical once A-Z are lower-cased; null counts as empty, so null and empty texts are one
    group. Of a group the row with the largest id stays: kept is true for exactly one row of it, also where ids repeat
    or whole rows do. A row without an id stays only if no row of its group has one; keep_id is null then. Equality is
    judged by SHA-256. Other columns are not read. An empty table gives no rows. filter_bytes bounds what is broadcast,
    bits (a row) only decides how many rows without a copy are shuffled with those that have one.
    """
    rows = digests(docs, id_col, text_col)
    blocks = max(1, -(-rows.count() * bits // BLOCK))
    at_once = max(1, filter_bytes * 8 // BLOCK)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("sha"), F.lit(blocks)))
    once, again = None, None
    for first in range(0, blocks, at_once):
        own = rows if blocks <= at_once else rows.where(F.col("block").between(first, first + at_once - 1))
        probed = possibly_repeated(own, stored(hit_twice(own), "bloom-filter"))
        single, rest = probed.where("not again"), probed.where("again").select("id", "row", "sha")
        if blocks > at_once:
            single, rest = stored(single, "bloom-once"), stored(rest, "bloom-again")
        once = single if once is None else once.unionByName(single)
        again = rest if again is None else again.unionByName(rest)
    passed = once.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return passed.unionByName(_decided(stored(again, "bloom-repeated"))).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
