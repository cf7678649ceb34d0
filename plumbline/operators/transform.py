"""Contract projections: one narrow select per table."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import Contract
from plumbline.functions.values import masked, normalised

CLIENT_COLUMN = "MANDT"


def _source_types(df: DataFrame) -> dict[str, tuple[str, T.DataType]]:
    """Column lookup without regard to case, as Spark resolves names."""
    return {f.name.lower(): (f.name, f.dataType) for f in df.schema.fields}


def _select_list(df: DataFrame, contract: Contract) -> list[tuple[str, Column | None, Column]]:
    """(target name, raw input or None, normalised expression) for every declared column."""
    present = _source_types(df)
    entries = []
    for field in contract.data_fields:
        found = present.get(field.source.lower())
        if found is None:
            entries.append((field.target, None, F.lit(None).cast(field.spark_type)))
            continue
        raw = F.col(f"`{found[0]}`")
        entries.append((field.target, raw, normalised(raw, field, found[1])))
    return entries


def normalise(df: DataFrame, contract: Contract) -> DataFrame:
    """Rename, clean and type the declared columns in contract order.

    A declared column that did not arrive is a typed NULL. Columns that begin with an underscore
    are audit columns and pass through; anything else, the client column included, is dropped.
    """
    declared = {f.source.lower() for f in contract.data_fields}
    audit = [c for c in df.columns if c.startswith("_") and c.lower() not in declared]
    exprs = [expr.alias(name) for name, _, expr in _select_list(df, contract)]
    return df.drop(CLIENT_COLUMN).select(*exprs, *audit)


def coercion_flags(df: DataFrame, contract: Contract) -> dict[str, tuple[Column, Column]]:
    """Per typed column: whether a value is there, and whether it is there but cannot be read as declared."""
    types = {f.target: f.spark_type for f in contract.data_fields}
    defaults = {f.target: f for f in contract.data_fields if f.default_sql is not None}
    present = _source_types(df)
    flags = {}
    for name, raw, expr in _select_list(df, contract):
        if raw is None or isinstance(types[name], T.StringType):
            continue
        if name in defaults:
            # A default would hide the loss, so look at the value before it.
            field = replace(defaults[name], default_sql=None)
            expr = normalised(raw, field, present[field.source.lower()][1])
        flags[name] = raw.isNotNull(), raw.isNotNull() & expr.isNull()
    return flags


def coercion_findings(df: DataFrame, contract: Contract) -> DataFrame:
    """Per column: values that were present but could not be read as the declared type.

    Rows ``(column_name, present_count, lost_count)`` from a single aggregate.
    """
    flags = coercion_flags(df, contract)
    aggregates = [F.count_if(f).alias(f"{k}_{c}") for c, both in flags.items() for k, f in zip("pl", both)]
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"p_{c}").alias("present_count"), F.col(f"l_{c}").alias("lost_count")) for c in flags]
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def mask_personal(df: DataFrame, contract: Contract) -> DataFrame:
    """Hash the personal columns, if the contract asks for it. For the analytical target only."""
    if not contract.mask_personal:
        return df
    return df.withColumns({c: masked(F.col(c)) for c in contract.personal_columns if c in df.columns})


def rename_only(df: DataFrame, contract: Contract) -> DataFrame:
    """Source names to target names, values untouched."""
    return df.withColumnsRenamed(contract.renames())


def with_extract_audit(df: DataFrame, contract: Contract, at: datetime) -> DataFrame:
    """Where a row came from and when. One time for the whole batch."""
    return df.withColumns({
        "_sap_system": F.lit(contract.system),
        "_sap_schema": F.lit(contract.schema),
        "_sap_table": F.lit(contract.table),
        "_extracted_at": F.lit(at).cast("timestamp"),
        "_extract_batch_id": F.lit(f"{contract.table}_{at:%Y%m%d%H%M%S}"),
    })


def with_load_audit(df: DataFrame, contract: Contract, batch_id: str, at: datetime) -> DataFrame:
    """Load-time columns. The extract time and the batch id are kept: rollback deletes by the latter."""
    extracted = F.col("_extracted_at") if "_extracted_at" in df.columns else F.lit(at).cast("timestamp")
    return df.select(
        *contract.columns,
        F.lit(contract.system).alias("_source_system"),
        extracted.alias("_extracted_at"),
        F.lit(at).cast("timestamp").alias("_loaded_at"),
        F.lit(True).alias("_is_current"),
        F.lit(batch_id).alias("_batch_id"),
    )


def schema_conformance(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared against actual: presence, type, and NULLs where the declaration forbids them.

    Rows ``(column_name, declared_type, actual_type, is_present, type_matches, null_violations)``.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    required = [f.target for f in contract.data_fields if not f.nullable and f.target in actual]
    counts = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in required]
    counts = counts or [F.count(F.lit(1)).alias("n_rows")]
    structs = []
    for field in contract.data_fields:
        have = actual.get(field.target)
        structs.append(F.struct(
            F.lit(field.target).alias("column_name"),
            F.lit(field.spark_type.simpleString()).alias("declared_type"),
            F.lit(have.simpleString() if have else None).cast("string").alias("actual_type"),
            F.lit(have is not None).alias("is_present"),
            F.lit(have == field.spark_type).alias("type_matches"),
            (F.col(f"n_{field.target}") if field.target in required else F.lit(0).cast("bigint"))
            .alias("null_violations"),
        ))
    return df.agg(*counts).select(F.inline(F.array(*structs)))


def expand_lookup(df: DataFrame, lookup: DataFrame, code: str, lookup_code: str, text: str, into: str) -> DataFrame:
    """Add the text of a code from a catalogue table; unknown codes keep their row.

    No broadcast hint: Spark broadcasts the catalogue when its measured size allows, and otherwise
    splits skewed codes while joining.
    """
    catalogue = lookup.select(F.col(lookup_code).alias("_code"), F.col(text).alias(into))
    return df.join(catalogue, df[code] == catalogue["_code"], "left").drop("_code")
