"""Data-quality rule suites, evaluated together.

All row-level rules of a table become columns of one aggregate. Only uniqueness needs a shuffle of
its own, one per key tuple, with map-side combining.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import Contract
from plumbline.operators.reconcile import FAILED, PASSED, WARNING, key_uniqueness

# Rule names and the pattern of an e-mail address.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
MATCH_REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTH_BETWEEN = "expect_column_value_lengths_to_be_between"
PAIR_LESS = "expect_column_pair_values_A_to_be_less_than_B"
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"

CRITICAL, ADVISORY = "CRITICAL", "WARNING"


@dataclass(frozen=True)
class Rule:
    expectation: str
    columns: tuple[str, ...]
    pattern: str | None = None
    values: tuple[str, ...] = ()
    low: object = None
    high: object = None
    or_equal: bool = False
    where: str | None = None
    severity: str = CRITICAL
    nulls_violate: bool = False
    """NULLs satisfy every rule but not-null unless this is set."""

    @property
    def label(self) -> str:
        return ",".join(self.columns)


# The business rules beyond what contracts imply, per target table.
EXTENDED_RULES = {
    "mdm.material_master": (
        Rule(IN_SET, ("material_type",), values=("HAWA", "FERT", "ROH", "HALB", "DIEN", "VERP", "LEIH")),
        Rule(BETWEEN, ("gross_weight",), low=0, high=100000, severity=ADVISORY),
    ),
    "mdm.customer_master": (
        Rule(MATCH_REGEX, ("email",), pattern=EMAIL_PATTERN, severity=ADVISORY),
        Rule(MATCH_REGEX, ("country_code",), pattern="^[A-Z]{2,3}$"),
    ),
    "mdm.vendor_master": (
        Rule(LENGTH_BETWEEN, ("tax_number_1",), low=9, high=16, where="country_code = 'US'", severity=ADVISORY),
    ),
    "mdm.price_history": (
        Rule(PAIR_LESS, ("valid_from", "valid_to"), or_equal=True),
        Rule(BETWEEN, ("price",), low=0.01, high=1000000),
        Rule(IN_SET, ("currency_code",),
             values=("USD", "EUR", "GBP", "JPY", "INR", "CAD", "AUD", "BRL", "CNY", "MXN")),
    ),
}


# What a declared field implies: when, and which rule. `alone` says that keys are judged column by column.
IMPLIED = (
    (lambda field, alone: not field.nullable, lambda field: Rule(NOT_NULL, (field.target,))),
    (lambda field, alone: field.key and alone, lambda field: Rule(UNIQUE, (field.target,))),
    (lambda field, alone: "email" in field.target, lambda field: Rule(MATCH_REGEX, (field.target,), pattern=EMAIL_PATTERN)),
    (lambda field, alone: bool(field.domain), lambda field: Rule(IN_SET, (field.target,), values=mapped_values(field))),
)


def mapped_values(field) -> tuple[str, ...]:
    """All that a mapped field can hold: its targets, and both truth values."""
    return tuple(dict.fromkeys([*(sql for _, sql in field.domain), "true", "false"]))


def contract_suite(contract: Contract, composite_key: bool = True) -> list[Rule]:
    """Rules the contract implies. A composite key is unique as a tuple, unless asked per column."""
    alone = not composite_key or len(contract.keys) == 1
    own = [make(field) for field in contract.data_fields for applies, make in IMPLIED if applies(field, alone)]
    return own if alone or not contract.keys else [*own, Rule(UNIQUE, tuple(contract.keys))]


def satisfied(rule: Rule) -> Column | None:
    """Three-valued check of one row; None for an unknown rule."""
    first = F.col(rule.columns[0])
    if rule.expectation == NOT_NULL:
        return first.isNotNull()
    if rule.expectation == MATCH_REGEX:
        return first.rlike(rule.pattern)
    if rule.expectation == IN_SET:
        return first.cast("string").isin([str(v) for v in rule.values])
    if rule.expectation in (BETWEEN, LENGTH_BETWEEN):
        value = F.length(first) if rule.expectation == LENGTH_BETWEEN else first
        check = F.lit(True)
        if rule.low is not None:
            check = check & (value >= F.lit(rule.low))
        if rule.high is not None:
            check = check & (value <= F.lit(rule.high))
        return check
    if rule.expectation == PAIR_LESS:
        second = F.col(rule.columns[1])
        return first <= second if rule.or_equal else first < second
    return None


def violated(rule: Rule) -> Column | None:
    """True where the rule applies and is broken; never NULL."""
    check = satisfied(rule)
    if check is None:
        return None
    broken = ~F.coalesce(check, F.lit(not rule.nulls_violate))
    return broken if rule.where is None else F.coalesce(F.expr(rule.where), F.lit(False)) & broken


def _outcome(position: int, rule: Rule, unexpected: Column, evaluated: Column, known: bool = True) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule.expectation).alias("expectation"),
        F.lit(rule.label).alias("column_name"),
        F.lit(rule.severity).alias("severity"),
        evaluated.cast("bigint").alias("evaluated_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        ((unexpected == 0) if known else F.lit(False)).alias("success"),
    )


def run_rules(df: DataFrame, suite: list[Rule]) -> DataFrame:
    """Rows ``(position, expectation, column_name, severity, evaluated_count, unexpected_count, success)``.

    An unknown rule, or one about a column that is not there, is a failed row and no exception.
    """
    aggregates = [F.count(F.lit(1)).alias("_total")]
    outcomes, parts = [], []
    for i, rule in enumerate(suite):
        missing = [c for c in rule.columns if c not in df.columns]
        if rule.expectation == UNIQUE and not missing:
            counted = key_uniqueness(df, list(rule.columns))
            outcome = _outcome(i, rule, F.col("duplicate_count"), F.col("total_rows"))
            parts.append(counted.select(F.inline(F.array(outcome))))
            continue
        broken = None if missing else violated(rule)
        if broken is None:
            outcomes.append(_outcome(i, rule, F.lit(0), F.lit(0), known=False))
            continue
        scope = F.lit(True) if rule.where is None else F.coalesce(F.expr(rule.where), F.lit(False))
        aggregates += [F.count_if(broken).alias(f"u{i}"), F.count_if(scope).alias(f"e{i}")]
        outcomes.append(_outcome(i, rule, F.col(f"u{i}"), F.col(f"e{i}")))
    if outcomes:
        parts.insert(0, df.agg(*aggregates).select(F.inline(F.array(*outcomes))))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def suite_status(rows: DataFrame) -> DataFrame:
    """Summary: success only if every rule holds; a broken advisory rule alone is a warning."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("passed"),
        F.bool_and("success").alias("success"),
        F.when(F.count_if(~F.col("success") & (F.col("severity") == CRITICAL)) > 0, FAILED)
        .when(F.count_if(~F.col("success")) > 0, WARNING)
        .otherwise(PASSED)
        .alias("status"),
    )
