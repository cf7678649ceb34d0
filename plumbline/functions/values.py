"""Value normalisation: padding, identifiers, flags, dates and numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import PADDED_KINDS, Field


def strip_padding(value: Column) -> Column:
    return F.rtrim(value)


def strip_leading_zeros(value: Column) -> Column:
    """'0007' -> '7'. All zeros, and the empty string, become '0'."""
    stripped = F.ltrim(value, F.lit("0"))
    return F.when(stripped == "", F.lit("0")).otherwise(stripped)


def map_domain(value: Column, domain: tuple[tuple[str, str], ...], to: T.DataType) -> Column:
    """First matching pair wins; NULL stays NULL; other values are kept if they can be cast."""
    mapped = F.when(value.isNull(), F.lit(None).cast(to))
    for source, sql in domain:
        mapped = mapped.when(value == F.lit(source), F.expr(sql).cast(to))
    return mapped.otherwise(value.try_cast(to))


def parse_date(value: Column) -> Column:
    return F.coalesce(F.try_to_date(value, "yyyyMMdd"), F.try_to_date(value))


def parse_time(value: Column) -> Column:
    """A time of day, as a timestamp on 1970-01-01."""
    return F.coalesce(F.try_to_timestamp(value, F.lit("HHmmss")), F.try_to_timestamp(value))


def parse_timestamp(value: Column) -> Column:
    return F.try_to_timestamp(value)


def normalised(value: Column, field: Field, arrives_as: T.DataType) -> Column:
    """The whole chain for one column: padding, identifier, flag or type, default."""
    is_text = isinstance(arrives_as, T.StringType)
    if field.kind in PADDED_KINDS:
        value = strip_padding(value.cast("string"))
        is_text = True
    if field.is_zero_padded_id:
        value = strip_leading_zeros(value)

    if field.domain:
        value = map_domain(value, field.domain, field.spark_type)
    elif field.kind == "DATE" and is_text:
        value = parse_date(value)
    elif field.kind == "TIME" and is_text:
        value = parse_time(value)
    elif field.kind in ("TIMESTAMP", "SECONDDATE") and is_text:
        value = parse_timestamp(value)
    elif arrives_as != field.spark_type and not isinstance(field.spark_type, (T.StringType, T.BinaryType)):
        value = value.try_cast(field.spark_type)

    if field.default_sql is not None:
        value = F.coalesce(value, F.expr(field.default_sql).cast(field.spark_type))
    return value


def masked(value: Column) -> Column:
    """SHA-256 in hex; NULL stays NULL."""
    return F.sha2(value.cast("string"), 256)
