"""Order-independent table checksums.

A row becomes text in which values are separated by colons, a free text is preceded by its length
and NULL has a mark, so that two different rows never look alike. The text is hashed with MD5, and
two 56-bit slices of the hash are summed per bucket. Sums have constant state, so they combine on
the map side, and unlike XOR they notice a row that occurs twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
NULL_MARK = "~"


def quoted(name: str) -> str:
    return f"`{name}`"


def portable_text(name: str, kind: T.DataType) -> str:
    """SQL text of a value that other engines print alike. Floats are fixed to ten decimals first."""
    col = quoted(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return f"coalesce(cast(try_cast({col} as decimal(38,10)) as string), cast({col} as string))"
    if isinstance(kind, T.BinaryType):
        return f"lower(hex({col}))"
    if isinstance(kind, T.TimestampType):
        # The wall clock of UTC, so that the text does not depend on the session's zone.
        return f"cast(timestampadd(MICROSECOND, unix_micros({col}), TIMESTAMP_NTZ'1970-01-01 00:00:00') as string)"
    return f"cast({col} as string)"


def row_text_sql(df: DataFrame, columns: list[str]) -> str:
    parts = []
    for name in columns:
        kind = df.schema[name].dataType
        text = portable_text(name, kind)
        if isinstance(kind, T.StringType):
            parts += [f"coalesce(cast(length({text}) as string), '{NULL_MARK}')", text]
        else:
            parts.append(f"coalesce({text}, '{NULL_MARK}')")
    return f"concat_ws(':', {', '.join(parts)})"


def row_text(df: DataFrame, columns: list[str]) -> Column:
    return F.expr(row_text_sql(df, columns))


def lane(md5_hex: str, which: int) -> str:
    """SQL text of slice 0 or 1 of an MD5, as a number of 56 bits."""
    return f"cast(conv(substring({md5_hex}, {1 + 14 * which}, 14), 16, 10) as bigint)"


def lane_sum(lane_column: str) -> str:
    """SQL text of the exact sum of a lane.

    The lane is summed in three pieces of 19 bits, as integers that hold for 2^44 rows per group,
    and put together at the end. Summing decimals row by row costs several times as much.
    """
    high, middle, low = f"shiftright({lane_column}, 38)", f"shiftright({lane_column}, 19) & 524287", f"{lane_column} & 524287"
    return (
        f"cast(sum({high}) as decimal(20,0)) * 274877906944BD"
        f" + cast(sum({middle}) as decimal(20,0)) * 524288BD + cast(sum({low}) as decimal(20,0))"
    )


def fast_hash(df: DataFrame, columns: list[str]) -> str:
    """SQL text of a 64-bit hash for comparisons inside Spark. NULL and its neighbours stay apart.

    Floats are hashed by their bits, not by their text, so the smallest difference counts.
    """
    parts = [
        f"isnull({quoted(c)}), {quoted(c) if is_float(df.schema[c].dataType) else portable_text(c, df.schema[c].dataType)}"
        for c in columns
    ]
    return f"xxhash64({', '.join(parts)})"


def is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def exact_lane(df: DataFrame, columns: list[str]) -> str:
    """SQL text of a third lane, for floats alone: what their portable text cuts off."""
    floats = [c for c in columns if is_float(df.schema[c].dataType)]
    if not floats:
        return "0L"
    return f"{fast_hash(df, floats)} & {2**56 - 1}L"


def key_bucket(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> Column:
    prefix = f"substring(md5({row_text_sql(df, keys)}), 1, 8)"
    return F.expr(f"cast(cast(conv({prefix}, 16, 10) as bigint) % {buckets} as int)")


def aligned(left: DataFrame, right: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the given columns in one type each; where types differ, as text."""
    differing = [c for c in columns if left.schema[c].dataType != right.schema[c].dataType]
    if not differing:
        return left, right
    return tuple(df.withColumns({c: F.expr(portable_text(c, df.schema[c].dataType)) for c in differing}) for df in (left, right))
