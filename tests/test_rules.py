import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from plumbline.mdm import CUSTOMER, MATERIAL, PRICE_HISTORY
from plumbline.operators import pii, rules
from plumbline.operators.rules import Rule
from plumbline.operators.transform import mask_personal, normalise
from plumbline.sources import shaped


def outcome(df, *suite):
    return [(r["success"], r["unexpected_count"]) for r in rules.run_rules(df, list(suite)).orderBy("position").collect()]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("1", "a@b.co", 5, 9, True), ("2", "bad", 7, 3, False), ("2", None, None, 1, None)],
        "id string, email string, low int, high int, flag boolean",
    )


@pytest.mark.parametrize("rule, expected", [
    (Rule(rules.NOT_NULL, ("email",)), (False, 1)),
    (Rule(rules.UNIQUE, ("id",)), (False, 1)),
    (Rule(rules.UNIQUE, ("id", "high")), (True, 0)),
    (Rule(rules.MATCH_REGEX, ("email",), pattern=rules.EMAIL_PATTERN), (False, 1)),
    (Rule(rules.MATCH_REGEX, ("email",), pattern=rules.EMAIL_PATTERN, nulls_violate=True), (False, 2)),
    (Rule(rules.MATCH_REGEX, ("email",), pattern="b"), (True, 0)),
    (Rule(rules.IN_SET, ("flag",), values=("true", "false")), (True, 0)),
    (Rule(rules.IN_SET, ("low",), values=("5",)), (False, 1)),
    (Rule(rules.BETWEEN, ("low",), low=6), (False, 1)),
    (Rule(rules.BETWEEN, ("low",), low=5, high=7), (True, 0)),
    (Rule(rules.LENGTH_BETWEEN, ("email",), low=4, high=9, where="id = '2'"), (False, 1)),
    (Rule(rules.PAIR_LESS, ("low", "high")), (False, 1)),
    (Rule(rules.PAIR_LESS, ("low", "low"), or_equal=True), (True, 0)),
    (Rule(rules.PAIR_LESS, ("low", "low")), (False, 2)),
    (Rule("expect_nothing_known", ("low",)), (False, 0)),
    (Rule(rules.NOT_NULL, ("absent",)), (False, 0)),
])
def test_rule(people, rule, expected):
    assert outcome(people, rule) == [expected]


def test_suite_shares_one_aggregate(people):
    suite = [Rule(rules.NOT_NULL, ("email",)), Rule(rules.BETWEEN, ("low",), low=1), Rule(rules.PAIR_LESS, ("low", "high"))]
    assert plan_of(rules.run_rules(people, suite)).count("Exchange") == 1


def test_contract_suites():
    names = [(r.expectation, r.label) for r in rules.contract_suite(CUSTOMER)]
    assert names == [
        (rules.NOT_NULL, "customer_number"), (rules.UNIQUE, "customer_number"),
        (rules.MATCH_REGEX, "email"), (rules.IN_SET, "is_deletion_flag"),
    ]
    assert (rules.UNIQUE, "material_number,valid_from") in [(r.expectation, r.label) for r in rules.contract_suite(PRICE_HISTORY)]
    single = rules.contract_suite(PRICE_HISTORY, composite_key=False)
    assert [r.label for r in single if r.expectation == rules.UNIQUE] == ["material_number", "valid_from"]


def test_status_by_severity(people):
    def status(*suite):
        return rules.suite_status(rules.run_rules(people, list(suite))).first()["status"]

    good = Rule(rules.NOT_NULL, ("id",))
    assert status(good) == "PASSED"
    assert status(good, Rule(rules.NOT_NULL, ("email",), severity=rules.ADVISORY)) == "WARNING"
    assert status(good, Rule(rules.NOT_NULL, ("email",))) == "FAILED"


def test_shipped_rules_find_the_planted_faults(spark):
    df = normalise(shaped.customers(spark, SMALL), CUSTOMER)
    rows = {r["column_name"]: r for r in rules.run_rules(df, list(rules.EXTENDED_RULES[CUSTOMER.analytical])).collect()}
    assert rows["email"]["unexpected_count"] == df.filter(F.col("email").contains(".example") & ~F.col("email").contains("@")).count() > 0
    assert rows["country_code"]["unexpected_count"] == df.filter("country_code = 'x1'").count()


def test_pii_audit(spark):
    df = normalise(shaped.customers(spark, SMALL), CUSTOMER)
    columns = CUSTOMER.personal_columns
    masked = pii.audit_columns(mask_personal(df, CUSTOMER), "t", columns)
    assert plan_of(masked).count("Exchange") == 1
    assert {r["status"] for r in masked.collect()} == {"MASKED"}
    assert pii.audit_status(masked).first()["overall_status"] == "PASS"
    raw = {r["column_name"]: r for r in pii.audit_columns(df, "t", columns).collect()}
    assert raw["t.email"]["status"] == "FAIL_RAW_PII_FOUND" and raw["t.email"]["raw_email_like"] > 0
    assert raw["t.phone_primary"]["raw_phone_like"] == df.count()
    empty = pii.audit_columns(df.limit(0), "t", columns)
    assert {r["status"] for r in empty.collect()} == {"NO_DATA"}


def test_masked_share_is_strict(spark):
    hashed = mask_personal(spark.range(95).selectExpr("cast(id as string) as email"), CUSTOMER)
    df = hashed.unionByName(spark.range(5).selectExpr("cast(id as string) as email"))
    assert pii.audit_columns(df, "t", ["email"]).first()["status"] == "FAIL_RAW_PII_FOUND"


def test_bounded_values(spark):
    df = spark.range(10).selectExpr("if(id < 5, null, cast(id as string)) as email")
    assert [r[0] for r in pii.bounded_values(df, "email", 3).collect()] == ["5", "6", "7"]
    assert MATERIAL.personal_columns == []
