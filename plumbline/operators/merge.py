"""Upserts, delete-and-insert, and latest-version-per-key, as functions from tables to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

OP_COLUMN = "Op"
DELETED = "_is_deleted"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Spark keeps only the top row per key in each task before it shuffles (window group limit), so
    a key with very many versions arrives as one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def delete_using(target: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not staged. NULL in a key equals NULL."""
    s = staged.select(*[F.col(k).alias(f"_staged_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_staged_{i}")) for i, k in enumerate(keys)]
    return target.join(s, same, "left_anti").select(*target.columns)


def matching(rows: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is staged. NULL in a key equals NULL."""
    s = staged.select(*[F.col(k).alias(f"_staged_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_staged_{i}")) for i, k in enumerate(keys)]
    return rows.join(s, same, "left_semi").select(*rows.columns)


def delete_insert(target: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the staged keys, then add every staged row. Without keys the rows are appended."""
    kept = delete_using(target, staged, keys) if keys else target
    return kept.unionByName(staged)


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Insert new keys and replace known ones.

    Several changes of a key are reduced to the last one by ``order``; without it, to the one with the
    greatest values, so that a key never comes twice. A table of keys alone has nothing to update:
    known keys stay, new keys come once.
    """
    if set(keys) == set(target.columns):
        fresh = changes.select(*target.columns).dropDuplicates(keys)
        return target.unionByName(delete_using(fresh, target, keys))
    changes = latest_per_key(changes, keys, order or [c for c in target.columns if c not in keys])
    return delete_insert(target, changes.select(*target.columns), keys)


def merge_matched(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Target and changes matched on the key, with what happened to each row.

    Both sides hold a key at most once: the target is a keyed table, and changes are reduced with
    ``latest_per_key`` before. Rows carry the target's columns and ``_action``.
    """
    values = [c for c in target.columns if c not in keys]
    in_target = F.coalesce(F.col("t._here"), F.lit(False))
    changed = F.coalesce(F.col("s._hit"), F.lit(False))
    t_marked = target.withColumn("_here", F.lit(True)).alias("t")
    s_marked = changes.withColumn("_hit", F.lit(True)).alias("s")
    matched = t_marked.join(s_marked, keys, "full_outer")
    action = (
        F.when(in_target & changed, "updated").when(changed, "inserted").otherwise("kept")
    )
    return matched.select(
        *keys,
        *[F.when(changed, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in values],
        action.alias("_action"),
    )


def tombstone(op: Column | None = None) -> Column:
    """Whether the change is a delete."""
    return F.coalesce((F.col(OP_COLUMN) if op is None else op) == "D", F.lit(False))


def to_versions(events: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Change events in the form state is kept in: values, order columns, delete mark."""
    return events.select(*columns, *[c for c in order if c not in columns], tombstone().alias(DELETED))


def apply_changes(state: DataFrame | None, versions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """State after the changes: the newest version per key, deletes kept as marked rows.

    A late change never replaces a newer version. With no state yet, the changes found it.
    """
    everything = versions if state is None else state.unionByName(versions.select(*state.columns))
    return latest_per_key(everything, keys, order)


def current_rows(state: DataFrame) -> DataFrame:
    """Rows that are not deleted."""
    return state.filter(~F.col(DELETED)).drop(DELETED)


def without_batch(df: DataFrame, batch_id: str) -> DataFrame:
    """The table as if the batch had not been loaded."""
    return df.filter(~F.col("_batch_id").eqNullSafe(F.lit(batch_id)))


def undo_batch(now: DataFrame, before: DataFrame, keys: list[str], batch_id: str) -> DataFrame:
    """The table without one batch's rows, and with the rows of before it that they had replaced. What later batches wrote stays."""
    mine = F.col("_batch_id").eqNullSafe(F.lit(batch_id))
    return now.filter(~mine).unionByName(matching(before, now.filter(mine), keys).select(*now.columns))


def retained(df: DataFrame, now, keep_days: int = 730, column: str = "_loaded_at") -> DataFrame:
    """Rows loaded within the retention period."""
    return df.filter(F.col(column) >= F.date_add(F.lit(now).cast("date"), -keep_days))
