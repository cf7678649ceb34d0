"""The given tables in the shape of source extracts: padded text, blank flags, yyyyMMdd dates.

Everything is a projection of a whole table, so these inputs grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.contracts import Contract
from plumbline.mdm import CUSTOMER, MATERIAL, ORDERS, PRICE_HISTORY, VENDOR
from plumbline.operators.transform import normalise
from plumbline.sources.files import table

# Codes used in source extracts.
MATERIAL_TYPES = ("HAWA", "FERT", "ROH", "HALB", "DIEN")
SECTORS = ("M", "C", "A")
UNITS = ("EA", "KG", "LB", "M", "L", "BX")
CURRENCIES = ("USD", "EUR", "GBP", "XXX")


def _text(value: Column) -> Column:
    return value.cast("string")


def _padded_number(value: Column, width: int) -> Column:
    return F.lpad(_text(value), width, "0")


def _pick(values: tuple[str, ...], key: Column) -> Column:
    choices = F.array(*[F.lit(v) for v in values])
    return F.get(choices, (key % len(values)).cast("int"))


def _day(start: str, offset: Column) -> Column:
    return F.date_format(F.date_add(F.lit(start).cast("date"), offset.cast("int")), "yyyyMMdd")


def _user(number: Column) -> Column:
    return F.rpad(F.concat(F.lit("USER"), _padded_number(number, 3)), 12, " ")


def country_code(nation: Column) -> Column:
    """Two capitals from the nation key; nation 0 is US, nation 13 is not a valid code."""
    letters = F.concat(F.char((nation / 5).cast("int") + 65), F.char(nation % 5 + 75))
    return F.when(nation == 0, "US").when(nation == 13, "x1").otherwise(letters)


def materials(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    return part.select(
        F.lit("001").alias("MANDT"),
        _padded_number(key, 18).alias("MATNR"),
        _day("2018-01-01", key % 2000).alias("ERSDA"),
        _user(key % 20).alias("ERNAM"),
        _day("2018-01-01", key % 2000 + key % 300).alias("LAEDA"),
        _user(key % 7).alias("AENAM"),
        _pick(MATERIAL_TYPES, key).alias("MTART"),
        _pick(SECTORS, key).alias("MBRSH"),
        F.concat(F.lit("MG"), _padded_number(key % 50, 3)).alias("MATKL"),
        F.rpad(_pick(UNITS, key), 3, " ").alias("MEINS"),
        F.concat(_text(F.col("p_size")), F.lit("."), _padded_number(key % 1000, 3)).alias("BRGEW"),
        F.when(key % 17 != 0, F.concat(_text(F.col("p_size")), F.lit("."), _padded_number(key * 7 % 1000, 3)))
        .alias("NTGEW"),
        F.lit("KG ").alias("GEWEI"),
        F.when(key % 100 == 0, "X").when(key % 97 != 0, "").alias("LVORM"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    mail = F.concat(F.lit("c"), _text(key), F.lit("@example.com"))
    return table(spark, folder, "customer").select(
        F.lit("001").alias("MANDT"),
        _padded_number(key, 10).alias("KUNNR"),
        F.rpad("c_name", 35, " ").alias("NAME1"),
        country_code(F.col("c_nationkey")).alias("LAND1"),
        F.concat(F.lit("CITY"), _text(key % 97)).alias("ORT01"),
        _padded_number(key % 100000, 5).alias("PSTLZ"),
        F.concat("c_mktsegment", F.lit(" "), _text(key % 999)).alias("STRAS"),
        F.concat(F.lit("+1-555-"), _padded_number(key, 7)).alias("TELF1"),
        F.when(key % 3 != 0, F.concat(F.lit("+1 (555) "), _padded_number(key, 7))).alias("TELFX"),
        F.when(key % 50 == 0, F.concat(F.lit("c"), _text(key), F.lit(".example.com")))
        .when(key % 31 != 0, mail)
        .alias("SMTP_ADDR"),
        _day("2010-01-01", key % 5000).alias("ERDAT"),
        _user(key % 20).alias("ERNAM"),
        F.when(key % 200 == 0, "X").when(key % 211 == 0, "Z").when(key % 97 != 0, "").alias("LOEVM"),
    )


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.lit("001").alias("MANDT"),
        _padded_number(key, 10).alias("LIFNR"),
        F.rpad("s_name", 35, " ").alias("NAME1"),
        country_code(F.col("s_nationkey")).alias("LAND1"),
        F.when(key % 2 == 0, _padded_number(key, 6)).otherwise(_padded_number(key, 9)).alias("STCD1"),
        F.when(key % 4 != 0, _padded_number(key * 7, 11)).alias("STCD2"),
        _day("2012-01-01", key % 4500).alias("ERDAT"),
        F.when(key % 10 == 0, "X").otherwise("").alias("LOEVM"),
    )


def price_history(spark: SparkSession, folder: str) -> DataFrame:
    """One price per part and day, valid until the part's next day with a price.

    Lines are reduced to one row per part and day before the window, so even a part that holds
    much of the table has a window no longer than the calendar.
    """
    daily = table(spark, folder, "lineitem").groupBy("l_partkey", "l_shipdate").agg(
        F.max(F.col("l_extendedprice").cast("decimal(12,2)")).alias("price")
    )
    by_part = Window.partitionBy("l_partkey").orderBy("l_shipdate")
    moment = "yyyy-MM-dd HH:mm:ss"
    return daily.select(
        _padded_number(F.col("l_partkey"), 18).alias("MATNR"),
        F.date_format("l_shipdate", moment).alias("VALID_FROM"),
        F.date_format(F.lead("l_shipdate").over(by_part), moment).alias("VALID_TO"),
        _text(F.col("price").cast("decimal(12,4)")).alias("PRICE"),
        F.rpad(_pick(CURRENCIES, F.col("l_partkey")), 5, " ").alias("CURRENCY"),
        F.lit("LP").alias("PRICE_TYPE"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


SHAPED = {
    "MARA": (materials, MATERIAL),
    "KNA1": (customers, CUSTOMER),
    "LFA1": (vendors, VENDOR),
    "ZPRICE_HISTORY": (price_history, PRICE_HISTORY),
    "ORDERS": (orders, ORDERS),
}


def extract(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, Contract]:
    """Source-shaped rows and contract by source table name."""
    build, contract = SHAPED[name]
    return build(spark, folder), contract


def normalised_orders(spark: SparkSession, folder: str) -> DataFrame:
    return normalise(orders(spark, folder), ORDERS)


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change log per user: errors delete, signups insert, all else updates."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U").alias("Op"),
        F.col("ts").alias("_dms_committed_at"),
        F.col("event_id").alias("_seq"),
        F.col("user_id").alias("USER_ID"),
        kind.alias("EVENT_TYPE"),
        F.col("value").alias("AMOUNT"),
        F.concat(F.lit("u"), _text(F.col("user_id")), F.lit("@example.com")).alias("EMAIL"),
    )


def damaged_orders(clean: DataFrame, *kinds: str) -> DataFrame:
    """A copy of normalised orders with faults of the named kinds.

    dropped: 1 in 100 rows missing; nulled: 1 in 11 priorities lost; duplicated: 1 in 500 rows
    twice; scaled: 1 in 250 prices times 100; swapped: the priorities of two neighbours exchanged.
    """
    key = F.col("order_key")
    df = clean
    if "swapped" in kinds:
        pair = (F.col("order_key") % 400).isin(7, 8)
        partner = clean.filter(pair).select(
            F.when(key % 400 == 7, key + 1).otherwise(key - 1).alias("order_key"),
            F.struct(F.col("order_priority").alias("value")).alias("_other"),
        )
        df = df.join(partner, "order_key", "left").withColumn(
            "order_priority",
            F.when(F.col("_other").isNotNull(), F.col("_other.value")).otherwise(F.col("order_priority")),
        ).select(*clean.columns)
    if "dropped" in kinds:
        df = df.filter(key % 100 != 0)
    if "nulled" in kinds:
        df = df.withColumn("order_priority", F.when(key % 11 != 0, F.col("order_priority")))
    if "scaled" in kinds:
        scaled = (F.col("total_price") * 100).cast(clean.schema["total_price"].dataType)
        df = df.withColumn("total_price", F.when(key % 250 == 3, scaled).otherwise(F.col("total_price")))
    if "duplicated" in kinds:
        df = df.unionByName(df.filter(key % 500 == 1))
    return df


def order_changes(clean: DataFrame, since: str) -> DataFrame:
    """A delta: orders from a day on with another status, and as many new ones beside them."""
    recent = clean.filter(F.col("order_date") >= F.lit(since).cast("date"))
    changed = recent.withColumn("order_status", F.lit("C"))
    new = recent.withColumns({
        "order_key": -F.col("order_key") - 1,
        "order_status": F.lit("N"),
    })
    return changed.unionByName(new)


def as_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Events as ledger entries: three events to a batch, a status by event type.

    Clicks are watermarks of the batch's table. The event id decides between equal times.
    """
    kind = F.col("event_type")
    status = F.when(kind == "signup", "STARTED").when(kind == "error", "FAILED").when(kind == "purchase", "SUCCEEDED")
    is_mark = kind == "click"
    return table(spark, folder, "events").filter(kind != "view").select(
        F.when(is_mark, "watermark").otherwise("batch").alias("kind"),
        F.lit("load").alias("job"),
        F.when(is_mark, F.concat(F.lit("table"), _text(F.col("user_id") % 40)))
        .otherwise(F.concat(F.lit("b"), _text(F.floor(F.col("event_id") / 3))))
        .alias("name"),
        status.alias("status"),
        F.col("ts").alias("at"),
        F.when(kind == "purchase", F.floor("value")).alias("row_count"),
        F.when(kind == "error", F.repeat(F.col("props"), 120)).alias("error_message"),
        F.when(is_mark, _text(F.col("ts"))).alias("watermark"),
        F.col("event_id").alias("seq"),
    )
