"""Checksum bands and the drill-down from a differing band to differing rows and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.digest import BUCKETS, aligned, fast_hash, key_bucket, quoted
from plumbline.operators.profile import bucket_profile

COMPARED = ("n", "lane0", "lane1", "lane2")


def bands_differ(left: str = "s", right: str = "t") -> Column:
    """A bucket on one side only, or with another count or checksum."""
    same = F.lit(True)
    for name in COMPARED:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return ~same


def checksum_bands(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """Every bucket with both counts, both checksums as text, and whether they differ."""
    source, target = aligned(source, target, columns)
    s = bucket_profile(source, keys, columns, [], buckets).alias("s")
    t = bucket_profile(target, keys, columns, [], buckets).alias("t")
    return s.join(t, F.col("s.bucket") == F.col("t.bucket"), "full_outer").select(
        F.coalesce("s.bucket", "t.bucket").alias("bucket"),
        F.col("s.n").alias("source_count"),
        F.col("t.n").alias("target_count"),
        F.concat_ws("-", F.col("s.lane0").cast("string"), F.col("s.lane1").cast("string")).alias("source_checksum"),
        F.concat_ws("-", F.col("t.lane0").cast("string"), F.col("t.lane1").cast("string")).alias("target_checksum"),
        bands_differ().alias("differs"),
    )


def differing_rows(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    columns: list[str],
    buckets: int = BUCKETS,
    only_buckets: list[int] | None = None,
) -> DataFrame:
    """Keys whose rows differ, with the reason and the columns concerned.

    Both sides are stacked with a sign and reduced per key, so a key with any number of copies
    shrinks on the map side and no join is involved. Equal multisets of rows cancel out to zero.
    ``only_buckets`` restricts the scan to the buckets a band comparison has flagged.

    Rows ``(<keys>, source_count, target_count, reason, columns)``.
    """
    compared = [c for c in columns if c not in keys]
    source, target = aligned(source, target, columns)

    # Hashes are summed in integer pieces of at most 22 bits, which hold for 2^41 rows per key.
    row_pieces = ("shiftright(_row, 43)", "shiftright(_row, 21) & 4194303", "_row & 2097151")
    column_pieces = ("shiftright({}, 43)", "shiftright({}, 21) & 4194303", "{} & 2097151")

    def signed(df: DataFrame, sides: tuple[int, int], prefix: str) -> DataFrame:
        if only_buckets is not None:
            df = df.filter(key_bucket(df, keys, buckets).isin(only_buckets))
        hashed = df.selectExpr(
            *[quoted(k) for k in keys],
            f"{fast_hash(df, columns)} as _row",
            *[f"{fast_hash(df, [c])} as _h{i}" for i, c in enumerate(compared)],
        )
        return hashed.selectExpr(
            *[quoted(k) for k in keys],
            f"{sides[0]}L as _s",
            f"{sides[1]}L as _t",
            *[f"{prefix}({piece}) as _r{p}" for p, piece in enumerate(row_pieces)],
            *[
                f"{prefix}({piece.format(f'_h{i}')}) as _c{i}_{p}"
                for i in range(len(compared)) for p, piece in enumerate(column_pieces)
            ],
        )

    reduced = signed(source, (1, 0), "").unionByName(signed(target, (0, 1), "-")).groupBy(*keys).agg(
        F.sum("_s").alias("source_count"),
        F.sum("_t").alias("target_count"),
        *[F.sum(f"_r{p}").alias(f"_r{p}") for p in range(len(row_pieces))],
        *[F.sum(f"_c{i}_{p}").alias(f"_c{i}_{p}") for i in range(len(compared)) for p in range(len(column_pieces))],
    ).filter("_r0 <> 0 or _r1 <> 0 or _r2 <> 0 or source_count <> target_count")

    reason = (
        F.when(F.col("target_count") == 0, "missing_in_target")
        .when(F.col("source_count") == 0, "missing_in_source")
        .when(F.col("source_count") != F.col("target_count"), "count_differs")
        .otherwise("values_differ")
    )
    named = [f"if(_c{i}_0 <> 0 or _c{i}_1 <> 0 or _c{i}_2 <> 0, '{c}', null)" for i, c in enumerate(compared)]
    changed = F.expr(f"concat_ws(',', {', '.join(named)})") if named else F.lit("")
    return reduced.select(
        *keys,
        "source_count",
        "target_count",
        reason.alias("reason"),
        F.when(F.col("source_count") == F.col("target_count"), changed).alias("columns"),
    )


def drill_down(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """Band comparison first, then row comparison inside the differing bands only.

    The list of differing bands has at most ``buckets`` entries and is the only thing collected.
    """
    flagged = [
        r["bucket"]
        for r in checksum_bands(source, target, keys, columns, buckets).filter("differs").select("bucket").collect()
    ]
    return differing_rows(source, target, keys, columns, buckets, only_buckets=flagged)


def exact_difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row-for-row multiset difference, both ways."""
    target = target.select(*source.columns)
    return (
        source.exceptAll(target).withColumn("side", F.lit("source_only"))
        .unionByName(target.exceptAll(source).withColumn("side", F.lit("target_only")))
    )
