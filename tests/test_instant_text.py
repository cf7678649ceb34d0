import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.digest import portable_text

DECIMAL_TEXT = "cast(TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(unix_micros(`t`) / 1000000BD as decimal(18,6))) as string)"
MICROS = (0, -1, 1, 999_999, -62_135_596_800_000_000, 253_402_300_799_999_999, 1_699_163_999_999_999, 1_699_164_000_000_000, -2_208_988_800_000_001, None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Apia"])
def test_text_of_instants_without_decimals(spark, zone):
    text = portable_text("t", T.TimestampType())
    # With a decimal for every value the text costs three times as much.
    assert "decimal" not in text and "1000000BD" not in text
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in MICROS], "m long").select(F.timestamp_micros("m").alias("t"))
        rows = df.selectExpr(f"{text} as new", f"{DECIMAL_TEXT} as old").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r["new"] for r in rows] == [r["old"] for r in rows] and rows[1]["new"] == "1969-12-31 23:59:59.999999" and rows[-1]["new"] is None
