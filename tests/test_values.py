from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.contracts import Contract, Field
from plumbline.mdm import CUSTOMER, MATERIAL
from plumbline.operators.transform import (
    coercion_findings, mask_personal, normalise, schema_conformance, with_extract_audit, with_load_audit,
)

SOURCE = "MANDT string, MATNR string, MTART string, MEINS string, LVORM string, ERSDA string, BRGEW string"


def one(spark, **values):
    base = dict(MANDT="001", MATNR="1", MTART="HAWA", MEINS="EA", LVORM="", ERSDA="20260421", BRGEW="1.5")
    base.update(values)
    return normalise(spark.createDataFrame([tuple(base.values())], SOURCE), MATERIAL).first()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("raw, expected", [
    ("000000000000001000", "1000"), ("000000000000020000", "20000"), ("MATA    ", "MATA"), ("", "0"),
    ("000", "0"), (None, None), ("0A0", "A0"), ("   ", "0"),
])
def test_identifier(spark, ansi, raw, expected):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, MATNR=raw)["material_number"] == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("raw, expected", [("X", True), ("", False), ("X ", True), ("Z", False), (None, False)])
def test_flag(spark, ansi, raw, expected):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, LVORM=raw)["is_deletion_flag"] is expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("raw, expected", [
    ("20260421", date(2026, 4, 21)), ("2026-04-21", date(2026, 4, 21)), ("20261341", None), ("", None), (None, None),
])
def test_date(spark, raw, expected):
    assert one(spark, ERSDA=raw)["created_on"] == expected


@pytest.mark.parametrize("raw, expected", [
    ("1.5", Decimal("1.500")), ("12345678901.1", None), ("2026-04-21", None), ("", None), (None, None),
])
def test_decimal(spark, raw, expected):
    assert one(spark, BRGEW=raw)["gross_weight"] == expected


def test_padding_client_column_and_missing_columns(spark):
    row = one(spark, MEINS="EA  ")
    assert row["base_unit_of_measure"] == "EA"
    assert "MANDT" not in row.asDict()
    assert list(row.asDict()) == MATERIAL.columns
    assert row["net_weight"] is None and row["weight_unit"] is None


def test_audit_columns_pass_and_others_do_not(spark):
    df = spark.createDataFrame([("1", "x", "y")], "MATNR string, _mark string, OTHER string")
    out = normalise(df, MATERIAL)
    assert "_mark" in out.columns and "OTHER" not in out.columns
    assert dict(out.dtypes)["net_weight"] == "decimal(13,3)"


TYPES = Contract("S", "S", "T", "t", "t", ("a",), (
    Field("A", "a", "TINYINT"), Field("B", "b", "BIGINT"), Field("C", "c", "REAL"), Field("D", "d", "DOUBLE"),
    Field("E", "e", "TIME"), Field("F", "f", "SECONDDATE"), Field("G", "g", "CLOB"), Field("H", "h", "BLOB"),
    Field("I", "i", "BOOLEAN"), Field("J", "j", "CHAR", default_sql="'UNKNOWN'"), Field("K", "k", "NCHAR"),
    Field("L", "l", "CHAR", domain=(("1", "'one'"), ("2", "'two'"))),
))


def test_every_type(spark):
    df = spark.createDataFrame(
        [("7", "9", "1.5", "2.5", "143015", "2026-04-21 02:03:04", "c  ", bytearray(b"x"), True, None, "n ", "3")],
        "A string, B string, C string, D string, E string, F string, G string, H binary, I boolean, J string, K string, L string",
    )
    row = normalise(df, TYPES).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == (7, 9, 1.5, 2.5)
    assert row["e"] == datetime(1970, 1, 1, 14, 30, 15)
    assert row["f"] == datetime(2026, 4, 21, 2, 3, 4)
    assert row["g"] == "c  " and row["h"] == bytearray(b"x") and row["i"] is True
    assert row["j"] == "UNKNOWN" and row["k"] == "n" and row["l"] == "3"


def test_typed_input_is_kept(spark):
    df = spark.sql("select date'2026-04-21' as ERSDA, 3 as MATNR, 1.5d as BRGEW")
    row = normalise(df, MATERIAL).first()
    assert (row["created_on"], row["material_number"], row["gross_weight"]) == (date(2026, 4, 21), "3", Decimal("1.500"))


def test_lost_values_are_counted(spark):
    df = spark.createDataFrame([("1", "X", "20260421"), ("2", "Z", "nope"), ("3", None, None)], "MATNR string, LVORM string, ERSDA string")
    found = {r["column_name"]: (r["present_count"], r["lost_count"]) for r in coercion_findings(df, MATERIAL).collect()}
    assert found == {"created_on": (2, 1), "is_deletion_flag": (2, 1)}


def test_masking(spark):
    df = spark.createDataFrame([("a@b.c", None, "keep")], "email string, fax string, city string")
    row = mask_personal(df, CUSTOMER).first()
    assert len(row["email"]) == 64 and row["fax"] is None and row["city"] == "keep"
    assert mask_personal(df, MATERIAL) is df


def test_audit_times_are_one_per_batch(spark):
    at = datetime(2026, 4, 21, 2, 15, 33)
    raw = with_extract_audit(spark.createDataFrame([("1",), ("2",)], "MATNR string"), MATERIAL, at)
    row = raw.first()
    assert row["_extract_batch_id"] == "MARA_20260421021533" and row["_sap_table"] == "MARA"
    loaded = with_load_audit(normalise(raw, MATERIAL), MATERIAL, "b1", datetime(2026, 4, 22))
    row = loaded.first()
    assert row["_extracted_at"] == at and row["_loaded_at"] == datetime(2026, 4, 22)
    assert row["_batch_id"] == "b1" and row["_is_current"] is True and row["_source_system"] == "HANA"


def test_schema_conformance(spark):
    df = normalise(spark.createDataFrame([("1",), (None,)], "MATNR string"), MATERIAL).drop("created_on").withColumn(
        "gross_weight", F.lit(1.0)
    )
    found = {r["column_name"]: r for r in schema_conformance(df, MATERIAL).collect()}
    assert found["material_number"]["null_violations"] == 1
    assert not found["created_on"]["is_present"]
    assert not found["gross_weight"]["type_matches"] and found["net_weight"]["type_matches"]
