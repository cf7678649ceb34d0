"""Table contracts: the declaration every scan, projection, check and sink is derived from."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Declared source type -> Spark type of the normalised column.
# DECIMAL is parameterised and handled in Field.spark_type.
SPARK_TYPES = {
    "CHAR": T.StringType(),
    "NCHAR": T.StringType(),
    "NVARCHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "STRING": T.StringType(),
    "CLOB": T.StringType(),
    "NCLOB": T.StringType(),
    "TINYINT": T.IntegerType(),
    "SMALLINT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "REAL": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIME": T.TimestampType(),
    "TIMESTAMP": T.TimestampType(),
    "SECONDDATE": T.TimestampType(),
    "VARBINARY": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
}

# Types whose trailing blanks are padding.
PADDED_KINDS = frozenset({"CHAR", "NCHAR", "VARCHAR", "NVARCHAR", "STRING"})

# Types compared by their sums.
NUMERIC_KINDS = frozenset({"DECIMAL", "REAL", "DOUBLE", "INTEGER", "BIGINT", "SMALLINT", "TINYINT"})

# Target columns that hold personal data.
PERSONAL_COLUMNS = ("email", "phone_primary", "fax", "customer_name", "vendor_name")

STRATEGIES = ("full_refresh", "incremental_merge", "append_only")


@dataclass(frozen=True)
class Field:
    """One column, from its source name and encoding to its target name and type."""

    source: str
    target: str
    kind: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    key: bool = False
    audit: bool = False
    domain: tuple[tuple[str, str], ...] = ()
    """Ordered (source value, SQL expression) pairs."""
    default_sql: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        if self.domain:
            is_flag = all(sql.lower() in ("true", "false") for _, sql in self.domain)
            return T.BooleanType() if is_flag else T.StringType()
        if self.kind == "DECIMAL":
            return T.DecimalType(self.precision, self.scale)
        return SPARK_TYPES[self.kind]

    @property
    def is_zero_padded_id(self) -> bool:
        return self.kind == "CHAR" and self.target.endswith(("_number", "_nr", "_id"))

    @property
    def is_numeric(self) -> bool:
        return self.kind in NUMERIC_KINDS and not self.domain and not self.audit


@dataclass(frozen=True)
class Contract:
    """Identity, layout, keys, columns and tolerances of one table."""

    system: str
    schema: str
    table: str
    operational: str
    analytical: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]
    partition_column: str | None = None
    partitions: int = 16
    strategy: str = "full_refresh"
    incremental: str | None = None
    count_tolerance_pct: float = 0.0
    null_drift_points: float = 5.0
    sum_drift_pct: float = 0.5
    lost_values: int = 0
    """Values per column that may be unreadable in an extract without stopping the run."""
    cdc: bool = True
    mask_personal: bool = False
    replicated: bool = False
    """Small lookup-like table: no distribution key in keyed layouts."""

    @property
    def fqn(self) -> str:
        return f"{self.system}:{self.schema}.{self.table}"

    @property
    def data_fields(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if not f.audit)

    @property
    def columns(self) -> list[str]:
        return [f.target for f in self.data_fields]

    @property
    def numeric_columns(self) -> list[str]:
        return [f.target for f in self.data_fields if f.is_numeric]

    @property
    def personal_columns(self) -> list[str]:
        return [c for c in self.columns if c in PERSONAL_COLUMNS]

    @property
    def incremental_source(self) -> str | None:
        return next((f.source for f in self.fields if f.target == self.incremental), None)

    def renames(self) -> dict[str, str]:
        return {f.source: f.target for f in self.data_fields if f.source != f.target}

    def target_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.target, f.spark_type, f.nullable) for f in self.data_fields])

    def source_text_schema(self) -> T.StructType:
        """All-text schema of a sample extract."""
        return T.StructType([T.StructField(f.source, T.StringType()) for f in self.data_fields])

    def with_tolerances(self, **changes: float) -> "Contract":
        """Same contract with other count, null or sum tolerances. Key uniqueness has none to relax."""
        allowed = {"count_tolerance_pct", "null_drift_points", "sum_drift_pct"}
        if unknown := set(changes) - allowed:
            raise ValueError(f"not a tolerance: {sorted(unknown)}")
        return replace(self, **changes)

    def problems(self) -> list[str]:
        """What is wrong with the declaration; empty when it can be used."""
        found = []
        targets = [f.target for f in self.fields]
        if len(set(targets)) != len(targets):
            found.append("target names repeat")
        for key in self.keys:
            field = next((f for f in self.fields if f.target == key), None)
            if field is None:
                found.append(f"key {key} is not a declared column")
            elif not field.key:
                found.append(f"key {key} is not marked as key")
        if self.partition_column and self.partition_column not in {f.source for f in self.fields}:
            found.append(f"partition column {self.partition_column} is not a declared source column")
        if self.strategy not in STRATEGIES:
            found.append(f"unknown load strategy {self.strategy}")
        if self.incremental and self.incremental not in targets:
            found.append(f"incremental column {self.incremental} is not a declared column")
        if self.strategy == "incremental_merge" and not self.incremental:
            found.append("incremental_merge needs an incremental column")
        for field in self.fields:
            if field.kind != "DECIMAL" and field.kind not in SPARK_TYPES:
                found.append(f"{field.target}: unknown type {field.kind}")
            if field.kind == "DECIMAL" and (field.precision is None or field.scale is None):
                found.append(f"{field.target}: DECIMAL needs precision and scale")
        return found
