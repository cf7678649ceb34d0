"""Shipped contracts: four master-data tables, and the plain tables used as large inputs."""

from __future__ import annotations

from plumbline.contracts import Contract, Field

# Fixed values: 'X' marks a set flag, blank an unset one.
FLAG = (("X", "true"), ("", "false"))


def _char(source: str, target: str, length: int, **kw) -> Field:
    return Field(source, target, "CHAR", length=length, **kw)


def _key(source: str, target: str, length: int) -> Field:
    return _char(source, target, length, nullable=False, key=True)


def _date(source: str, target: str) -> Field:
    return Field(source, target, "DATE")


def _decimal(source: str, target: str, precision: int, scale: int) -> Field:
    return Field(source, target, "DECIMAL", precision=precision, scale=scale)


def _deletion_flag(source: str) -> Field:
    return _char(source, "is_deletion_flag", 1, domain=FLAG, default_sql="false")


# Source and target names, types and keys of the four tables.
MATERIAL = Contract(
    system="HANA", schema="SAPSR3", table="MARA",
    operational="mdm.material_master", analytical="mdm.material_master",
    partition_column="MATNR", partitions=32,
    keys=("material_number",),
    strategy="incremental_merge", incremental="last_changed_on",
    fields=(
        _key("MATNR", "material_number", 18),
        _date("ERSDA", "created_on"),
        _char("ERNAM", "created_by", 12),
        _date("LAEDA", "last_changed_on"),
        _char("AENAM", "last_changed_by", 12),
        _char("MTART", "material_type", 4),
        _char("MBRSH", "industry_sector", 1),
        _char("MATKL", "material_group", 9),
        _char("MEINS", "base_unit_of_measure", 3),
        _decimal("BRGEW", "gross_weight", 13, 3),
        _decimal("NTGEW", "net_weight", 13, 3),
        _char("GEWEI", "weight_unit", 3),
        _deletion_flag("LVORM"),
    ),
)

CUSTOMER = Contract(
    system="HANA", schema="SAPSR3", table="KNA1",
    operational="mdm.customer_master", analytical="mdm.customer_master",
    partition_column="KUNNR", partitions=32,
    keys=("customer_number",),
    # New customers alone: changes of old ones come by the change feed (run_cdc).
    strategy="incremental_merge", incremental="created_on",
    mask_personal=True,
    fields=(
        _key("KUNNR", "customer_number", 10),
        _char("NAME1", "customer_name", 35),
        _char("LAND1", "country_code", 3),
        _char("ORT01", "city", 35),
        _char("PSTLZ", "postal_code", 10),
        _char("STRAS", "street_address", 35),
        _char("TELF1", "phone_primary", 16),
        _char("TELFX", "fax", 31),
        _char("SMTP_ADDR", "email", 241),
        _date("ERDAT", "created_on"),
        _char("ERNAM", "created_by", 12),
        _deletion_flag("LOEVM"),
    ),
)

VENDOR = Contract(
    system="HANA", schema="SAPSR3", table="LFA1",
    operational="mdm.vendor_master", analytical="mdm.vendor_master",
    partition_column="LIFNR", partitions=16,
    keys=("vendor_number",),
    # Its only date is that of creation, which tells nothing of changes.
    strategy="full_refresh", incremental="created_on",
    replicated=True,
    fields=(
        _key("LIFNR", "vendor_number", 10),
        _char("NAME1", "vendor_name", 35),
        _char("LAND1", "country_code", 3),
        _char("STCD1", "tax_number_1", 16),
        _char("STCD2", "tax_number_2", 11),
        _date("ERDAT", "created_on"),
        _deletion_flag("LOEVM"),
    ),
)

PRICE_HISTORY = Contract(
    system="HANA", schema="SAPSR3", table="ZPRICE_HISTORY",
    operational="mdm.price_history", analytical="mdm.price_history",
    partition_column="VALID_FROM", partitions=48,
    keys=("material_number", "valid_from"),
    strategy="incremental_merge", incremental="valid_from",
    cdc=False,
    fields=(
        _key("MATNR", "material_number", 18),
        Field("VALID_FROM", "valid_from", "TIMESTAMP", nullable=False, key=True),
        Field("VALID_TO", "valid_to", "TIMESTAMP"),
        _decimal("PRICE", "price", 12, 4),
        _char("CURRENCY", "currency_code", 5),
        _char("PRICE_TYPE", "price_type", 2),
    ),
)

REGISTRY = {c.table: c for c in (MATERIAL, CUSTOMER, VENDOR, PRICE_HISTORY)}

# Contracts over the plain order and line tables, whose columns arrive typed.
ORDERS = Contract(
    system="DW", schema="SALES", table="ORDERS",
    operational="sales.orders", analytical="sales.orders",
    partition_column="o_orderkey", partitions=32,
    keys=("order_key",),
    strategy="incremental_merge", incremental="order_date",
    fields=(
        Field("o_orderkey", "order_key", "BIGINT", nullable=False, key=True),
        Field("o_custkey", "customer_key", "BIGINT"),
        Field("o_orderstatus", "order_status", "VARCHAR", length=1),
        _decimal("o_totalprice", "total_price", 14, 2),
        _date("o_orderdate", "order_date"),
        Field("o_orderpriority", "order_priority", "VARCHAR", length=15),
    ),
)

ACTIVITY = Contract(
    system="DW", schema="WEB", table="ACTIVITY",
    operational="web.activity", analytical="web.activity",
    keys=("user_id",),
    fields=(
        Field("USER_ID", "user_id", "BIGINT", nullable=False, key=True),
        Field("EVENT_TYPE", "event_type", "VARCHAR", length=20),
        _decimal("AMOUNT", "amount", 14, 2),
        Field("EMAIL", "email", "VARCHAR", length=241),
    ),
    mask_personal=True,
)


def contract_for(table: str) -> Contract | None:
    return REGISTRY.get(table)


def contracts_with_cdc() -> list[Contract]:
    return [c for c in REGISTRY.values() if c.cdc]
