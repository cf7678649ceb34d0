"""For each registered query, SQL that another engine can run on the same tables.

Written from the definitions, not from the DataFrame code: source-shaped inputs, projections and
results are spelled out again here.
"""

from __future__ import annotations

# --- source-shaped inputs --------------------------------------------------------------------

MARA_SRC = """
select '001' as MANDT, lpad(p_partkey::varchar, 18, '0') as MATNR,
  strftime(date '2018-01-01' + (p_partkey % 2000)::int, '%Y%m%d') as ERSDA,
  rpad('USER' || lpad((p_partkey % 20)::varchar, 3, '0'), 12, ' ') as ERNAM,
  strftime(date '2018-01-01' + (p_partkey % 2000 + p_partkey % 300)::int, '%Y%m%d') as LAEDA,
  rpad('USER' || lpad((p_partkey % 7)::varchar, 3, '0'), 12, ' ') as AENAM,
  (['HAWA','FERT','ROH','HALB','DIEN'])[(p_partkey % 5 + 1)::int] as MTART,
  (['M','C','A'])[(p_partkey % 3 + 1)::int] as MBRSH,
  'MG' || lpad((p_partkey % 50)::varchar, 3, '0') as MATKL,
  rpad((['EA','KG','LB','M','L','BX'])[(p_partkey % 6 + 1)::int], 3, ' ') as MEINS,
  p_size || '.' || lpad((p_partkey % 1000)::varchar, 3, '0') as BRGEW,
  case when p_partkey % 17 <> 0 then p_size || '.' || lpad((p_partkey * 7 % 1000)::varchar, 3, '0') end as NTGEW,
  'KG ' as GEWEI,
  case when p_partkey % 100 = 0 then 'X' when p_partkey % 97 <> 0 then '' end as LVORM
from part"""

COUNTRY = (
    "case when {n} = 0 then 'US' when {n} = 13 then 'x1' else chr(({n} // 5 + 65)::int) || chr(({n} % 5 + 75)::int) end"
)

KNA1_SRC = f"""
select '001' as MANDT, lpad(c_custkey::varchar, 10, '0') as KUNNR, rpad(c_name, 35, ' ') as NAME1,
  {COUNTRY.format(n="c_nationkey")} as LAND1,
  'CITY' || (c_custkey % 97) as ORT01, lpad((c_custkey % 100000)::varchar, 5, '0') as PSTLZ,
  c_mktsegment || ' ' || (c_custkey % 999) as STRAS,
  '+1-555-' || lpad(c_custkey::varchar, 7, '0') as TELF1,
  case when c_custkey % 3 <> 0 then '+1 (555) ' || lpad(c_custkey::varchar, 7, '0') end as TELFX,
  case when c_custkey % 50 = 0 then 'c' || c_custkey || '.example.com'
       when c_custkey % 31 <> 0 then 'c' || c_custkey || '@example.com' end as SMTP_ADDR,
  strftime(date '2010-01-01' + (c_custkey % 5000)::int, '%Y%m%d') as ERDAT,
  rpad('USER' || lpad((c_custkey % 20)::varchar, 3, '0'), 12, ' ') as ERNAM,
  case when c_custkey % 200 = 0 then 'X' when c_custkey % 211 = 0 then 'Z' when c_custkey % 97 <> 0 then '' end as LOEVM
from customer"""

LFA1_SRC = f"""
select '001' as MANDT, lpad(s_suppkey::varchar, 10, '0') as LIFNR, rpad(s_name, 35, ' ') as NAME1,
  {COUNTRY.format(n="s_nationkey")} as LAND1,
  case when s_suppkey % 2 = 0 then lpad(s_suppkey::varchar, 6, '0') else lpad(s_suppkey::varchar, 9, '0') end as STCD1,
  case when s_suppkey % 4 <> 0 then lpad((s_suppkey * 7)::varchar, 11, '0') end as STCD2,
  strftime(date '2012-01-01' + (s_suppkey % 4500)::int, '%Y%m%d') as ERDAT,
  case when s_suppkey % 10 = 0 then 'X' else '' end as LOEVM
from supplier"""


def _id(column: str) -> str:
    return f"case when ltrim(rtrim({column}), '0') = '' then '0' else ltrim(rtrim({column}), '0') end"


def _date(column: str) -> str:
    return f"try_strptime({column}, '%Y%m%d')::date"


def _flag(column: str) -> str:
    return f"case rtrim({column}) when 'X' then true else false end"


MARA = f"""
select {_id('MATNR')} as material_number, {_date('ERSDA')} as created_on, rtrim(ERNAM) as created_by,
  {_date('LAEDA')} as last_changed_on, rtrim(AENAM) as last_changed_by, rtrim(MTART) as material_type,
  rtrim(MBRSH) as industry_sector, rtrim(MATKL) as material_group, rtrim(MEINS) as base_unit_of_measure,
  BRGEW::decimal(13,3) as gross_weight, NTGEW::decimal(13,3) as net_weight, rtrim(GEWEI) as weight_unit,
  {_flag('LVORM')} as is_deletion_flag
from ({MARA_SRC})"""

KNA1 = f"""
select {_id('KUNNR')} as customer_number, rtrim(NAME1) as customer_name, rtrim(LAND1) as country_code, ORT01 as city,
  PSTLZ as postal_code, STRAS as street_address, TELF1 as phone_primary, TELFX as fax, SMTP_ADDR as email,
  {_date('ERDAT')} as created_on, rtrim(ERNAM) as created_by, {_flag('LOEVM')} as is_deletion_flag
from ({KNA1_SRC})"""

KNA1_MASKED = f"""
select * replace (sha256(customer_name) as customer_name, sha256(phone_primary) as phone_primary,
  sha256(fax) as fax, sha256(email) as email)
from ({KNA1})"""

LFA1 = f"""
select {_id('LIFNR')} as vendor_number, rtrim(NAME1) as vendor_name, rtrim(LAND1) as country_code,
  STCD1 as tax_number_1, STCD2 as tax_number_2, {_date('ERDAT')} as created_on, {_flag('LOEVM')} as is_deletion_flag
from ({LFA1_SRC})"""

PRICES = """
select l_partkey::varchar as material_number, l_shipdate as valid_from,
  lead(l_shipdate) over (partition by l_partkey order by l_shipdate) as valid_to,
  price::decimal(12,4) as price,
  (['USD','EUR','GBP','XXX'])[(l_partkey % 4 + 1)::int] as currency_code, 'LP' as price_type
from (select l_partkey, l_shipdate, max(l_extendedprice::decimal(12,2)) as price from lineitem group by all)"""

ORDERS = """
select o_orderkey as order_key, o_custkey as customer_key, rtrim(o_orderstatus) as order_status,
  o_totalprice::decimal(14,2) as total_price, o_orderdate::date as order_date, rtrim(o_orderpriority) as order_priority
from orders"""

ORDER_COLUMNS = ("order_key", "customer_key", "order_status", "total_price", "order_date", "order_priority")


def damaged(*kinds: str) -> str:
    priority = "order_priority"
    source = f"({ORDERS})"
    if "swapped" in kinds:
        partner = "case when order_key % 400 = 7 then order_key + 1 when order_key % 400 = 8 then order_key - 1 end"
        source = f"""(select a.* replace (case when b.order_key is not null then b.order_priority else a.order_priority
          end as order_priority) from ({ORDERS}) a left join ({ORDERS}) b
          on b.order_key = {partner.replace('order_key', 'a.order_key')})"""
    where = "order_key % 100 <> 0" if "dropped" in kinds else "true"
    if "nulled" in kinds:
        priority = "case when order_key % 11 <> 0 then order_priority end"
    price = "total_price"
    if "scaled" in kinds:
        price = "case when order_key % 250 = 3 then (total_price * 100)::decimal(14,2) else total_price end"
    sql = f"""select order_key, customer_key, order_status, {price} as total_price, order_date,
      {priority} as order_priority from {source} where {where}"""
    if "duplicated" in kinds:
        sql = f"{sql} union all select * from ({sql}) where order_key % 500 = 1"
    return sql


ALL_DAMAGE = ("dropped", "nulled", "duplicated", "scaled", "swapped")


def sides(*kinds: str) -> str:
    """CTEs: the clean and the damaged orders."""
    return f"with s as ({ORDERS}), t as ({damaged(*kinds)})"


def row_text(columns) -> str:
    free = ("order_status", "order_priority")
    parts = [f"coalesce(length({c})::varchar, '~'), {c}" if c in free else f"coalesce({c}::varchar, '~')" for c in columns]
    return f"concat_ws(':', {', '.join(parts)})"


def lane(md5: str, which: int) -> str:
    return f"('0x' || substr({md5}, {1 + 14 * which}, 14))::bigint::hugeint"


def bands(table: str, columns=ORDER_COLUMNS, keys=("order_key",)) -> str:
    return f"""select ('0x' || substr(md5({row_text(keys)}), 1, 8))::bigint % 256 as bucket, count(*) as n,
      sum({lane(f'md5({row_text(columns)})', 0)})::hugeint || '-' || sum({lane(f'md5({row_text(columns)})', 1)})::hugeint
      as checksum from {table} group by 1"""


# --- reconciliation --------------------------------------------------------------------------

CASES: dict[str, str] = {}


def count_row(tolerance: float = 0.0) -> str:
    return f"""select 'row_count' as layer,
      case when s_n = 0 then 'WARNING' when abs(s_n - t_n)::double / s_n * 100 <= {tolerance} then 'PASSED' else 'FAILED' end as status,
      'source=' || format('{{:,}}', s_n) || ' target=' || format('{{:,}}', t_n) || ' diff='
        || printf('%.3f', abs(s_n - t_n)::double / s_n * 100) || '%' as message,
      '{{"source_count":' || s_n || ',"target_count":' || t_n || ',"difference_pct":"'
        || printf('%.4f', abs(s_n - t_n)::double / s_n * 100) || '","tolerance_pct":"{tolerance}"}}' as evidence
      from (select (select count(*) from s) as s_n, (select count(*) from t) as t_n)"""


def null_row(points: float = 5.0) -> str:
    per_column = " union all ".join(
        f"""select {i} as pos, '{c}' as col,
          (select count(*) filter ({c} is null)::double / count(*) * 100 from s) as sp,
          (select count(*) filter ({c} is null)::double / count(*) * 100 from t) as tp"""
        for i, c in enumerate(ORDER_COLUMNS)
    )
    return f"""select 'null_ratio' as layer,
      case when n = 0 then 'PASSED' when n <= 2 then 'WARNING' else 'FAILED' end as status,
      case when n = 0 then 'All columns within null-ratio tolerance'
           else n || ' column(s) exceeded {points}% null-ratio drift' end as message,
      case when n > 0 then '[' || items || ']' end as evidence
      from (select count(*) as n, string_agg('{{"column":"' || col || '","source_null_pct":"' || printf('%.2f', sp)
        || '","target_null_pct":"' || printf('%.2f', tp) || '","drift_pct":"' || printf('%.2f', abs(sp - tp)) || '"}}', ',' order by pos) as items
        from ({per_column}) where abs(sp - tp) > {points})"""


def unique_row() -> str:
    return """select 'pk_uniqueness' as layer, case when dups = 0 then 'PASSED' else 'FAILED' end as status,
      case when dups = 0 then 'All ' || format('{:,}', total) || ' rows have unique PK'
           else format('{:,}', dups) || ' duplicate PK combinations found' end as message,
      case when dups > 0 then '{"total_rows":' || total || ',"distinct_pks":' || dist || ',"duplicate_count":' || dups
        || ',"sample_duplicates":[' || samples || ']}' end as evidence
      from (select count(*) as total, count(distinct order_key) as dist, count(*) - count(distinct order_key) as dups from t),
        (select string_agg(j, ',' order by j) as samples from (
          select '{"order_key":' || order_key || ',"count":' || count(*) || '}' as j from t group by order_key
          having count(*) > 1 order by count(*) desc, order_key limit 5))"""


def checksum_row() -> str:
    return f"""select 'checksum_bands' as layer, case when n = 0 then 'PASSED' else 'FAILED' end as status,
      case when n = 0 then 'All 256 buckets match between source and target'
           else n || ' bucket(s) differ — row-level content mismatch' end as message,
      case when n > 0 then '[' || items || ']' end as evidence
      from (select count(*) as n, string_agg('{{"bucket":' || bucket || case when sn is null then '' else ',"source_rows":' || sn end
          || case when tn is null then '' else ',"target_rows":' || tn end || '}}', ',' order by bucket) filter (rk <= 10) as items
        from (select coalesce(a.bucket, b.bucket) as bucket, a.n as sn, b.n as tn,
            row_number() over (order by coalesce(a.bucket, b.bucket)) as rk
          from ({bands('s')}) a full join ({bands('t')}) b on a.bucket = b.bucket
          where a.n is distinct from b.n or a.checksum is distinct from b.checksum))"""


def stats_row(limit: float = 0.5) -> str:
    per_column = " union all ".join(
        f"""select {i} as pos, '{c}' as col, (select coalesce(sum({c}), 0)::decimal(38,6) from s) as ss,
          (select coalesce(sum({c}), 0)::decimal(38,6) from t) as ts"""
        for i, c in enumerate(("order_key", "customer_key", "total_price"))
    )
    return f"""select 'statistical_distribution' as layer, case when n = 0 then 'PASSED' else 'FAILED' end as status,
      case when n = 0 then 'All 3 numeric columns within tolerance'
           else n || ' numeric column(s) drifted beyond {limit}%' end as message,
      case when n > 0 then '[' || items || ']' end as evidence
      from (select count(*) as n, string_agg('{{"column":"' || col || '","source_sum":"' || ss || '","target_sum":"' || ts
        || '","diff_pct":"' || printf('%.4f', pct) || '"}}', ',' order by pos) as items
        from (select *, abs(ss - ts)::double / abs(ss)::double * 100 as pct from ({per_column})) where pct > {limit})"""


def report(*kinds: str, count: float = 0.0, points: float = 5.0, sums: float = 0.5, evidence: bool = True) -> str:
    rows = " union all ".join([count_row(count), null_row(points), unique_row(), checksum_row(), stats_row(sums)])
    last = ", evidence" if evidence else ""
    return f"""{sides(*kinds)} select 'DW:SALES.ORDERS' as contract_fqn, 'batch-0905' as batch_id,
      layer, status, message{last} from ({rows})"""


CASES["material_normalise"] = MARA
CASES["customer_normalise"] = KNA1
CASES["customer_masked"] = KNA1_MASKED
CASES["vendor_normalise"] = LFA1
CASES["price_history_build"] = PRICES
CASES["rename_columns"] = f"""
select MANDT, MATNR as material_number, ERSDA as created_on, ERNAM as created_by, LAEDA as last_changed_on,
  AENAM as last_changed_by, MTART as material_type, MBRSH as industry_sector, MATKL as material_group,
  MEINS as base_unit_of_measure, BRGEW as gross_weight, NTGEW as net_weight, GEWEI as weight_unit,
  LVORM as is_deletion_flag from ({MARA_SRC})"""
CASES["typed_values"] = """
select l_orderkey as a_bigint, case when not bad then l_quantity::int end as b_integer,
  case when not bad then l_extendedprice::decimal(10,2) end as c_decimal, l_quantity::int::double as d_double,
  case when bad then date '2031-09-05' else l_shipdate::date end as e_date,
  timestamp '1970-01-01 00:30:15' + to_hours(l_linenumber::int) as f_time,
  case when not bad then l_shipdate end as g_timestamp, l_returnflag as h_text, l_linestatus || '  ' as i_clob,
  null::decimal(9,2) as j_missing
from (select *, l_orderkey % 13 = 0 as bad from lineitem)"""
CASES["lookup_expand"] = f"""
with n as (select {COUNTRY.format(n="n_nationkey")} as code, n_name, r_name from nation
  left join region on n_regionkey = r_regionkey)
select customer_number, country_code, n_name as country_name, r_name as region_name
from ({KNA1}) left join n on country_code = code"""
CASES["schema_check"] = f"""
with m as ({MARA}), bad as (select count(*) filter (gross_weight >= 40) as n from m)
select column_name, declared_type, actual_type, actual_type is not null as is_present,
  coalesce(declared_type = actual_type, false) as type_matches,
  case when column_name = 'material_number' then (select n from bad) else 0 end as null_violations
from (values ('material_number', 'string', 'string'), ('created_on', 'date', 'date'), ('created_by', 'string', 'string'),
  ('last_changed_on', 'date', 'date'), ('last_changed_by', 'string', 'string'), ('material_type', 'string', 'string'),
  ('industry_sector', 'string', 'string'), ('material_group', 'string', 'string'),
  ('base_unit_of_measure', 'string', 'string'), ('gross_weight', 'decimal(13,3)', 'double'),
  ('net_weight', 'decimal(13,3)', 'decimal(13,3)'), ('weight_unit', 'string', null),
  ('is_deletion_flag', 'boolean', 'boolean')) v(column_name, declared_type, actual_type)"""
CASES["coercion_losses"] = f"""
select 'created_on' as column_name, count(ERDAT) as present_count, 0::bigint as lost_count from ({KNA1_SRC})
union all select 'is_deletion_flag', count(LOEVM), count(*) filter (LOEVM = 'Z') from ({KNA1_SRC})"""
CASES["extract_audit"] = f"""
select *, 'HANA' as _sap_system, 'SAPSR3' as _sap_schema, 'LFA1' as _sap_table,
  timestamp '2031-09-05 03:40:12' as _extracted_at, 'LFA1_20310905034012' as _extract_batch_id from ({LFA1})"""
CASES["load_audit"] = f"""
select *, 'HANA' as _source_system, timestamp '2031-09-05 03:40:12' as _extracted_at,
  timestamp '2031-09-05 03:40:12' as _loaded_at, true as _is_current, 'batch-0905' as _batch_id from ({LFA1})"""


def profile(table: str, numeric: dict[str, str], text: list[str], quantiles: bool = False) -> str:
    quantile = missing = ""
    if quantiles:
        quantile = """, quantile_disc({c}::double, 0.5) as median_value, quantile_disc({c}::double, 0.95) as p95_value"""
        missing = ", null::double, null::double"
    parts = [
        f"""select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as null_count,
          min({c})::double as min_value, max({c})::double as max_value, sum({c}::{kind})::decimal(38,6) as sum_value,
          round(sum({c}::{kind})::decimal(38,6)::double / count({c}), 4) as mean_value,
          round(stddev_samp({c}::double), 4) as stddev_value{quantile.format(c=c)} from {table}"""
        for c, kind in numeric.items()
    ] + [
        f"""select '{c}', count(*), count(*) - count({c}), null::double, null::double, null::decimal(38,6),
          null::double, null::double{missing} from {table}"""
        for c in text
    ]
    return " union all ".join(parts)


CASES["profile_lineitem"] = profile(
    "lineitem",
    {"l_orderkey": "bigint", "l_quantity": "decimal(28,6)", "l_extendedprice": "decimal(28,6)", "l_discount": "decimal(28,6)"},
    ["l_returnflag"],
)
CASES["profile_orders"] = profile(
    f"({damaged('nulled')})", {"order_key": "bigint", "total_price": "decimal(14,2)"}, ["order_priority"]
)
CASES["profile_part"] = profile(
    "part", {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "decimal(28,6)"}, ["p_brand"], quantiles=True
)
CASES["sketch_periods"] = " union all ".join(
    f"select strftime(l_shipdate, '{period}') as period, '{c}' as column_name, count({c}) as n from lineitem group by 1"
    for c in ("l_quantity", "l_extendedprice") for period in ("%Y-%m", "%Y"))
CASES["recon_row_count"] = f"{sides('dropped')} {count_row()}"
CASES["recon_null_drift"] = f"{sides('nulled')} {null_row()}"
CASES["recon_pk_unique"] = f"{sides('duplicated')} {unique_row()}"
CASES["recon_stats"] = f"{sides('scaled')} {stats_row()}"
CASES["recon_checksum_bands"] = f"""{sides('swapped')}
select coalesce(a.bucket, b.bucket)::int as bucket, a.n as source_count, b.n as target_count,
  coalesce(a.checksum, '') as source_checksum, coalesce(b.checksum, '') as target_checksum,
  a.n is distinct from b.n or a.checksum is distinct from b.checksum as differs
from ({bands('s')}) a full join ({bands('t')}) b on a.bucket = b.bucket"""


def differing(left: str, right: str) -> str:
    """Row comparison by joining, for keys that occur at most once on the left."""
    changed = ", ".join(
        f"case when a.{c} is distinct from b.{c} then '{c}' end" for c in ORDER_COLUMNS if c != "order_key"
    )
    return f"""
select order_key, sc as source_count, tc as target_count,
  case when tc = 0 then 'missing_in_target' when sc = 0 then 'missing_in_source' when sc <> tc then 'count_differs'
       else 'values_differ' end as reason,
  case when sc = tc then concat_ws(',', {changed}) end as columns
from (select order_key, sum(s)::bigint as sc, sum(t)::bigint as tc from
    (select order_key, 1 as s, 0 as t from {left} union all select order_key, 0, 1 from {right}) group by order_key) k
  left join {left} a using (order_key)
  left join (select distinct on (order_key) * from {right}) b using (order_key)
where sc <> tc or a is distinct from b"""


CASES["recon_drilldown"] = sides(*ALL_DAMAGE) + differing("s", "t")
CASES["recon_report"] = report(*ALL_DAMAGE)
CASES["recon_report_swapped"] = report("swapped", evidence=False)
CASES["recon_report_tolerant"] = report(*ALL_DAMAGE, count=2.0, points=10.0, sums=100.0, evidence=False)
CASES["recon_overall"] = f"""
select contract_fqn, batch_id, timestamp '2031-09-05 03:40:12' as validated_at, case when bool_or(status = 'FAILED') then 'FAILED'
  when bool_or(status = 'WARNING') then 'WARNING' else 'PASSED' end as overall_status,
  (select count(*) from orders) as source_row_count, (select count(*) from orders) as target_row_count,
  count(*)::int as results
from ({report('nulled')}) group by contract_fqn, batch_id"""
CASES["recon_missing_column"] = f"""
select layer, case when layer = 'checksum_bands' then 'FAILED' else status end as status from ({report('scaled')})"""
CASES["duplicate_keys"] = """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1"""
CASES["dup_key_evidence"] = """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1
order by n desc, l_orderkey, l_linenumber limit 5"""
CASES["exact_diff"] = f"""{sides(*ALL_DAMAGE)}
select *, 'source_only' as side from (select * from s except all select * from t)
union all select *, 'target_only' from (select * from t except all select * from s)"""

IN_WINDOW = "order_date > date '1996-01-01' and order_date <= date '1999-12-31'"
CASES["window_parity"] = f"""{sides('dropped')}
select sc as source_count, tc as target_count, round(abs(sc - tc)::double / sc * 100, 4) as diff_pct,
  case when abs(sc - tc)::double / sc * 100 < 0.1 then 'PASSED' else 'FAILED' end as status
from (select (select count(*) from s where {IN_WINDOW}) as sc, (select count(*) from t where {IN_WINDOW}) as tc)"""
CASES["window_pk_unique"] = f"""{sides('duplicated')}
select count(*) as total_rows, count(*) - count(distinct order_key) as duplicate_count,
  case when count(*) = count(distinct order_key) then 'PASSED' else 'FAILED' end as status from t where {IN_WINDOW}"""
OLD = "(select * from {} where order_date <= date '1996-01-01')"
CASES["stale_row_check"] = sides("scaled", "nulled") + differing(OLD.format("s"), OLD.format("t"))


def spot(source: str, target: str, seed: int) -> str:
    return f"""select order_key, order_key in (select order_key from {source}) as found_in_source from (
      select order_key from {target}
      order by md5('{seed}:' || order_key), order_key limit 50) group by order_key"""


CASES["pk_spot_check"] = f"{sides('dropped')} {spot('t', 's', 7)}"
CASES["run_incremental"] = f"""{sides('dropped', 'duplicated')},
  sw as (select * from s where {IN_WINDOW}), tw as (select * from t where {IN_WINDOW}),
  spot as ({spot('sw', 'tw', 0)})
select 'row_count_window' as layer, case when abs(sc - tc)::double / sc * 100 < 0.1 then 'PASSED' else 'FAILED' end as status,
  '{{"source_count":' || sc || ',"target_count":' || tc || '}}' as evidence
  from (select (select count(*) from sw) as sc, (select count(*) from tw) as tc)
union all select 'pk_uniqueness_window', case when d = 0 then 'PASSED' else 'FAILED' end,
  '{{"duplicates":' || d || ',"total":' || n || '}}' from (select count(*) as n, count(*) - count(distinct order_key) as d from tw)
union all select 'pk_spot_check', case when n = f then 'PASSED' else 'FAILED' end,
  '{{"sample_size":' || n || ',"found_count":' || f || '}}'
  from (select count(*) as n, count(*) filter (found_in_source) as f from spot)"""

THREE = f"""with raw as ({KNA1}), rawm as ({KNA1_MASKED}),
  op as (select * replace (case when customer_number::bigint % 100 = 5 then lower(city) else city end as city) from raw),
  opm as (select * replace (case when customer_number::bigint % 100 = 5 then lower(city) else city end as city) from rawm),
  an as (select * from rawm where customer_number::bigint % 40 <> 0),
  pairs as (
    select 'raw_vs_operational' as comparison, (select count(*) from raw) = (select count(*) from op) as same_count,
      (select count(*) from (select * from raw except all select * from op)) = 0 as same_rows
    union all select 'raw_vs_analytical', (select count(*) from rawm) = (select count(*) from an),
      (select count(*) from (select * from rawm except all select * from an)) = 0
    union all select 'operational_vs_analytical', (select count(*) from opm) = (select count(*) from an),
      (select count(*) from (select * from opm except all select * from an)) = 0),
  layers as (select comparison, 'row_count' as layer, case when same_count then 'PASSED' else 'FAILED' end as status from pairs
    union all select comparison, 'checksum_bands', case when same_rows then 'PASSED' else 'FAILED' end from pairs
    union all select comparison, unnest(['null_ratio', 'pk_uniqueness', 'statistical_distribution']), 'PASSED' from pairs)"""
CASES["three_way_parity"] = f"{THREE} select comparison, layer, status from layers"
CASES["run_post_load"] = f"""{THREE} select comparison,
  case when bool_or(status = 'FAILED') then 'FAILED' else 'PASSED' end as status from layers group by comparison"""
CASES["three_way_status"] = f"""{THREE}
select case when bool_or(status = 'FAILED') then 'FAILED' else 'PASSED' end as overall_status from layers"""
CASES["shadow_diff_rate"] = """
select ts::date as day, count(*) as requests,
  count(*) filter (event_id % 400 = 7 or event_id % 250 = 0) as mismatches,
  round(count(*) filter (event_id % 400 = 7 or event_id % 250 = 0)::double / count(*) * 100, 4) as mismatch_pct
from events group by 1"""
CASES["rollback_signal"] = f"select * from ({CASES['shadow_diff_rate']}) where mismatch_pct > 0.7"
CASES["latency_gate"] = """
select o as old_p99, n as new_p99, case when n < o * 1.1 then 'PASSED' else 'FAILED' end as status
from (select quantile_disc(value, 0.99) filter (event_type = 'view') as o,
  quantile_disc(value, 0.99) filter (event_type = 'click') as n from events)"""
CASES["orphan_check"] = """
select l_orderkey as foreign_key, count(*) as orphan_rows from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1"""
CASES["prerequisite_check"] = """
select distinct c_nationkey as nation, c_mktsegment from customer
where c_nationkey not in (select s_nationkey from supplier where s_acctbal > 8000)"""

# --- rules -----------------------------------------------------------------------------------

EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"


def rule(pos: int, name: str, column: str, table: str, bad: str, where: str = "true", severity: str = "CRITICAL") -> str:
    return f"""select {pos}::int as position, '{name}' as expectation, '{column}' as column_name, '{severity}' as severity,
      count(*) filter ({where}) as evaluated_count, count(*) filter ({where} and {bad}) as unexpected_count,
      count(*) filter ({where} and {bad}) = 0 as success from {table}"""


def unique_rule(pos: int, columns: str, table: str) -> str:
    return f"""select {pos}::int, 'expect_column_values_to_be_unique', '{columns}', 'CRITICAL', count(*),
      count(*) - (select count(*) from (select distinct {columns} from {table})),
      count(*) = (select count(*) from (select distinct {columns} from {table})) from {table}"""


NOT_NULL = "expect_column_values_to_not_be_null"
REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
CASES["rules_suite"] = f"with c as ({KNA1}) " + " union all ".join([
    rule(0, NOT_NULL, "customer_number", "c", "customer_number is null"),
    unique_rule(1, "customer_number", "c"),
    rule(2, REGEX, "email", "c", f"not regexp_matches(email, '{EMAIL}')"),
    rule(3, IN_SET, "is_deletion_flag", "c", "is_deletion_flag::varchar not in ('true', 'false')"),
])
CASES["rules_composite_key"] = f"with p as ({PRICES}) " + " union all ".join([
    rule(0, NOT_NULL, "material_number", "p", "material_number is null"),
    rule(1, NOT_NULL, "valid_from", "p", "valid_from is null"),
    unique_rule(2, "material_number,valid_from", "p"),
])
CASES["rules_single_columns"] = f"with p as ({PRICES}) " + " union all ".join([
    rule(0, NOT_NULL, "material_number", "p", "material_number is null"),
    unique_rule(1, "material_number", "p"),
    rule(2, NOT_NULL, "valid_from", "p", "valid_from is null"),
    unique_rule(3, "valid_from", "p"),
])
CUSTOMER_RULES = [
    rule(0, REGEX, "email", "c", f"not regexp_matches(email, '{EMAIL}')", severity="WARNING"),
    rule(1, REGEX, "country_code", "c", "not regexp_matches(country_code, '^[A-Z]{2,3}$')"),
]
EXTENDED = {
    "mdm.material_master": [
        rule(0, IN_SET, "material_type", "m", "material_type not in ('HAWA','FERT','ROH','HALB','DIEN','VERP','LEIH')"),
        rule(1, BETWEEN, "gross_weight", "m", "not gross_weight between 0 and 100000", severity="WARNING"),
    ],
    "mdm.customer_master": CUSTOMER_RULES,
    "mdm.vendor_master": [
        rule(0, "expect_column_value_lengths_to_be_between", "tax_number_1", "v",
             "not length(tax_number_1) between 9 and 16", "country_code = 'US'", "WARNING"),
    ],
    "mdm.price_history": [
        rule(0, "expect_column_pair_values_A_to_be_less_than_B", "valid_from,valid_to", "p", "valid_from > valid_to"),
        rule(1, BETWEEN, "price", "p", "not price between 0.01 and 1000000"),
        rule(2, IN_SET, "currency_code", "p",
             "currency_code not in ('USD','EUR','GBP','JPY','INR','CAD','AUD','BRL','CNY','MXN')"),
    ],
}
CASES["rules_extended"] = f"with m as ({MARA}), c as ({KNA1}), v as ({LFA1}), p as ({PRICES}) " + " union all ".join(
    f"select '{name}' as table_name, * from ({' union all '.join(parts)})" for name, parts in EXTENDED.items()
)
CASES["rules_unknown"] = f"with c as ({KNA1}) " + " union all ".join([
    rule(0, "expect_the_unexpected", "email", "c", "true", "false").replace("= 0 as success", "< 0 as success"),
    rule(1, NOT_NULL, "no_such_column", "c", "true", "false").replace("= 0 as success", "< 0 as success"),
    rule(2, NOT_NULL, "email", "c", "email is null"),
])
CASES["rules_status"] = f"""with c as ({KNA1})
select count(*) as total, count(*) filter (success) as passed, bool_and(success) as success,
  case when bool_or(not success and severity = 'CRITICAL') then 'FAILED' when bool_or(not success) then 'WARNING'
       else 'PASSED' end as status
from ({' union all '.join(CUSTOMER_RULES)})"""
CASES["predicate_counts"] = f"""
select count(*) filter (email is null) as null_emails, count(email) as filled_emails,
  count(*) filter (not regexp_matches(email, '{EMAIL}')) as bad_emails,
  count(*) filter (email is null or not regexp_matches(email, '{EMAIL}')) as bad_or_null_emails,
  count(*) filter (not is_deletion_flag) as flags_not_true,
  count(*) filter (country_code = 'US' and fax is null) as us_without_fax,
  count(*) filter (fax is distinct from phone_primary) as fax_differs
from ({KNA1})"""


def audited(column: str, table: str) -> str:
    return f"""select 'mdm.customer_master.{column}' as column_name, count({column}) as checked,
      count(*) filter (regexp_matches({column}, '^[0-9a-f]{{64}}$')) as hashed_count,
      count(*) filter (regexp_matches({column}, '{EMAIL}')) as raw_email_like,
      count(*) filter (regexp_matches({column}, '^[\\+\\d\\-\\(\\)\\s]{{7,}}$')) as raw_phone_like,
      case when count({column}) = 0 then 'NO_DATA'
        when count(*) filter (regexp_matches({column}, '^[0-9a-f]{{64}}$')) > count({column}) * 0.95 then 'MASKED'
        else 'FAIL_RAW_PII_FOUND' end as status from {table}"""


LEAKY = f"""with leaky as (select m.* replace (r.phone_primary as phone_primary, null::varchar as fax,
    case when m.customer_number::bigint % 30 = 1 then r.email else m.email end as email)
  from ({KNA1_MASKED}) m join ({KNA1}) r using (customer_number)) """
AUDITED = " union all ".join(audited(c, "leaky") for c in ("customer_name", "phone_primary", "fax", "email"))
CASES["pii_audit"] = LEAKY + AUDITED
CASES["run_pii_audit"] = f"""{LEAKY}
select case when bool_or(status = 'FAIL_RAW_PII_FOUND') then 'FAIL' else 'PASS' end as overall_status,
  count(*) as columns_checked, count(*) filter (status = 'FAIL_RAW_PII_FOUND') as failed_columns from ({AUDITED})"""
CASES["bounded_scan"] = f"select email from ({KNA1}) where email is not null order by email limit 1000"

# --- merges ----------------------------------------------------------------------------------

RECENT = f"select * from ({ORDERS}) where order_date >= date '2000-06-01'"
CHANGES = f"""select * replace ('C' as order_status) from ({RECENT})
  union all select * replace (-order_key - 1 as order_key, 'N' as order_status) from ({RECENT})"""
MERGED = f"""select * from ({ORDERS}) where order_key not in (select order_key from ({CHANGES}))
  union all select * from ({CHANGES})"""
CASES["upsert_orders"] = MERGED
CASES["delete_insert_orders"] = MERGED
CASES["upsert_keys_only"] = f"select order_key from ({ORDERS}) union select order_key from ({CHANGES})"
CASES["delete_using_orders"] = f"""
select * from ({ORDERS}) where order_key not in (select order_key from ({CHANGES}))"""
CASES["merge_full_outer"] = f"""
select m.*, case when m.order_status = 'C' then 'updated' when m.order_status = 'N' then 'inserted' else 'kept' end as _action
from ({MERGED}) m"""

FEED = """select case event_type when 'error' then 'D' when 'signup' then 'I' else 'U' end as Op, ts as _dms_committed_at,
  event_id as _seq, user_id as USER_ID, event_type as EVENT_TYPE, value as AMOUNT,
  'u' || user_id || '@example.com' as EMAIL from events"""
LATEST = f"""select * from ({FEED})
  qualify row_number() over (partition by USER_ID order by _dms_committed_at desc, _seq desc) = 1"""
CASES["cdc_latest"] = LATEST
CASES["cdc_silver"] = f"""
select USER_ID, EVENT_TYPE, AMOUNT, _dms_committed_at, _seq, Op = 'D' as _is_deleted from ({LATEST})"""
CASES["cdc_current"] = f"""
select USER_ID, EVENT_TYPE, AMOUNT, _dms_committed_at, _seq from ({LATEST}) where Op <> 'D'"""
CASES["bronze_stream"] = FEED
CASES["bronze_audit_columns"] = "select event_id as _seq, case when event_id % 3 = 0 then 2 else 1 end as ingest_run, true as in_its_file from events"
CASES["schema_evolution_stream"] = f"""
select * replace (case when _seq % 3 = 0 then EMAIL end as EMAIL) from ({FEED})"""
SILVER = f"""select USER_ID as user_id, EVENT_TYPE as event_type, AMOUNT::decimal(14,2) as amount, EMAIL as email,
  _dms_committed_at, _seq, Op = 'D' as _is_deleted from ({LATEST})"""
CASES["cdc_silver_stream"] = SILVER
CASES["schema_found_in_files"] = f"""
select *, case when _seq % 3 = 2 then EMAIL end as declared_email, case when _seq % 3 = 1 then EMAIL end as rescued_email
from (select * replace (case when _seq % 3 > 0 then EMAIL end as EMAIL) from ({FEED}))"""
CASES["run_cdc"] = f"select * exclude (_is_deleted) from ({SILVER}) where not _is_deleted"
CASES["dual_target_stream"] = f"""
select 'operational' as side, user_id, email, _is_deleted from ({SILVER})
union all select 'analytical', user_id, sha256(email), _is_deleted from ({SILVER})"""
ARRIVALS = "select 'T' || (user_id % 5) as table_name, ts from events where event_type <> 'click'"
CASES["debounce_5min"] = f"""
select table_name, time_bucket(interval '5 minutes', ts) as period_start, min(ts) as triggered_at
from ({ARRIVALS}) group by 1, 2"""
CASES["debounce_stream"] = f"""
select distinct table_name, time_bucket(interval '5 minutes', ts) as period_start from ({ARRIVALS})"""

CASES["two_cadence_stream"] = CASES["dual_target_stream"]
CASES["debounce_stream_late"] = """
with b as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from events),
  a as (select event_type <> 'click' as named, 'T' || (user_id % 5) as table_name, ts, event_id, ((epoch_us(ts) - lo) * 5 // (hi - lo + 1))::int as k from events cross join b),
  t as (select *, case when event_id % 50 = 0 then least(k + 1, 4) when event_id % 70 = 0 then least(k + 3, 4) else k end as arrives from a),
  m as (select arrives, max(ts) as newest from t group by 1),
  w as (select arrives, max(newest) over (order by arrives rows between unbounded preceding and 2 preceding) - interval '10 minutes' as mark from m)
select table_name, time_bucket(interval '5 minutes', ts) as period_start, min(ts) as triggered_at
from t join w using (arrives)
where named and (mark is null or time_bucket(interval '5 minutes', ts) + interval '5 minutes' > mark) group by 1, 2"""
CASES["queue_loads"] = """
with m as (select trunc(avg(o_orderkey))::bigint as middle from orders)
select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey <= middle then 1 when o_orderkey <= 2 * middle then 2 else 3 end as load
from orders cross join m"""

# --- ledger ----------------------------------------------------------------------------------

ENTRIES = """select 'load' as job, 'b' || (event_id // 3) as name,
  case event_type when 'signup' then 'STARTED' when 'error' then 'FAILED' else 'SUCCEEDED' end as status, ts as "at",
  case when event_type = 'purchase' then floor(value)::bigint end as row_count,
  case when event_type = 'error' then repeat(props, 120) end as error_message, event_id as seq
from events where event_type in ('signup', 'error', 'purchase')"""
NEWEST = f"""select * from ({ENTRIES}) qualify row_number() over (partition by name order by "at" desc, seq desc) = 1"""
CASES["ledger_latest"] = f"""select job, name, status, "at", row_count from ({NEWEST})"""
CASES["ledger_items"] = f"""
select n.job, n.name, n.status, a.started_at, a.completed_at, n.row_count, substr(n.error_message, 1, 1000) as error_message
from ({NEWEST}) n join (select name, max("at") filter (status = 'STARTED') as started_at,
  max("at") filter (status <> 'STARTED') as completed_at from ({ENTRIES}) group by name) a using (name)"""
CASES["ledger_stuck"] = f"""
select job, name, "at" from ({NEWEST}) where status = 'STARTED' and "at" < timestamp '2024-01-30 00:00:00'"""
MARKS = "select 'load' as job, 'table' || (user_id % 40) as name, ts from events where event_type = 'click'"
CASES["ledger_watermark"] = f"select job, name, max(ts)::varchar as watermark, max(ts) as updated_at from ({MARKS}) group by 1, 2"
WORK = "select distinct 'load' as job, 'b' || (event_id // 3) as name from events"
CASES["work_list"] = f"""
select * from ({WORK}) where name not in (select name from ({NEWEST}) where status = 'SUCCEEDED')"""
CASES["startable_batches"] = f"""
select * from ({WORK}) where name not in (select name from ({NEWEST}) where status <> 'FAILED')"""
CASES["ledger_expiry"] = """
select case when event_type = 'click' then 'watermark' else 'batch' end as kind, count(*) as entries, min(ts) as oldest
from events where event_type = 'click' or (event_type <> 'view' and ts >= timestamp '2024-01-21 00:00:00') group by 1"""
CASES["ledger_compaction"] = """
select case when event_type = 'click' then 'watermark' else 'batch' end as kind,
  case event_type when 'signup' then 'STARTED' when 'error' then 'FAILED' when 'purchase' then 'SUCCEEDED' end as status,
  count(*) as n, max(event_id) as newest, 1 as files
from events where event_type = 'click' or (event_type <> 'view' and ts >= timestamp '2024-01-21 00:00:00') group by 1, 2"""
CASES["ledger_audit"] = f"""select name, status, "at" from ({ENTRIES}) where starts_with(name, 'b12')"""
LOADED = f"""select *, strftime(order_date, '%Y-%m') as _batch_id, order_date::timestamp as _loaded_at from ({ORDERS})"""
CASES["rollback_by_batch"] = f"select * from ({LOADED}) where _batch_id <> '1998-07'"
CASES["rollback_delta"] = f"with s as ({ORDERS}), t as ({MERGED}) " + differing("s", "t")
CASES["stored_version_delta"] = CASES["rollback_delta"]
KEY_MD5 = f"md5({row_text(['order_key'])})"
LEAF = f"(('0x' || substr({KEY_MD5}, 1, 8))::bigint % 256 * 64 + ('0x' || substr({KEY_MD5}, 9, 8))::bigint % 64)::int"
LEAF_OF_16 = LEAF.replace("% 256", "% 16")
CASES["stored_version_report"] = f"""
with s as ({ORDERS}), t as ({MERGED}), d as ({differing("s", "t")}),
  leaves as (select {LEAF_OF_16} as leaf from s union select {LEAF_OF_16} from t)
select (select count(*) from s) as left_rows, (select count(*) from t) as right_rows, (select count(*) from leaves) as leaves,
  count(distinct {LEAF_OF_16}) as differing_leaves, count(*) filter (reason = 'missing_in_target') as missing_right,
  count(*) filter (reason = 'missing_in_source') as missing_left,
  count(*) filter (reason not in ('missing_in_target', 'missing_in_source')) as changed,
  case when count(*) = 0 then 'PASSED' else 'FAILED' end as status
from d"""
LATE = CHANGES.replace("2000-06-01", "2000-09-01").replace("* replace (", "* replace ('9-LATE' as order_priority, ")
CASES["digest_maintained"] = f"""
with state as (select * from ({MERGED}) where order_key not in (select order_key from ({LATE})) union all select * from ({LATE})),
  l as (select bucket, count(*) as leaves from (select distinct {LEAF} // 64 as bucket, {LEAF} from state) group by 1)
select b.bucket::int as bucket, leaves, n, checksum from ({bands("state")}) b join l using (bucket)"""
CASES["digest_stale_leaves"] = f"""
{sides("scaled")}, a as (select {LEAF} as leaf, count(*) as n from s group by 1), b as (select {LEAF} as leaf, count(*) as n from t group by 1)
select leaf, a.n as left_count, b.n as right_count from a join b using (leaf)
where leaf in (select {LEAF} from ({differing("s", "t")}))"""
CASES["rollback_restore"] = f"select *, 'b1' as _batch_id from ({ORDERS})"
CASES["rollback_delete_batch"] = f"""
select *, 'b1' as _batch_id from ({ORDERS}) where order_key not in (select order_key from ({CHANGES}))"""
THIRD = f"select * replace ('T' as order_status) from ({CHANGES}) where order_key % 3 = 0"
CASES["rollback_undo_batch"] = f"""
select *, 'b1' as _batch_id from ({ORDERS}) where order_key not in (select order_key from ({THIRD})) union all select *, 'b3' from ({THIRD})"""
CASES["retention_purge"] = f"select * from ({LOADED}) where _loaded_at >= date '2001-08-01' - 730"
CASES["retention_purge_rewrite"] = CASES["retention_purge"]
CASES["batch_scoped_count"] = f"""
select _batch_id, count(*) as n from ({LOADED}) where _loaded_at > timestamp '1998-06-30 12:00:00' group by 1"""

# --- gates, alarms ---------------------------------------------------------------------------

NIGHTS = """select event_type, ts::date as day, avg(case when value > 100 then 1.0 else 0.0 end) < 0.15 as green
  from events group by all"""
STREAKS = f"""select event_type as table_name, min(day) as first_day, max(day) as last_day, count(*) as nights from (
    select event_type, day, day - row_number() over (partition by event_type order by day)::int as island
    from ({NIGHTS}) where green) group by event_type, island"""


def streak_gate(needed: int) -> str:
    return f"""select l.table_name, l.last_day, coalesce(s.nights, 0)::bigint as green_nights,
      coalesce(s.nights, 0) >= {needed} as gate_open
      from (select event_type as table_name, max(day) as last_day from ({NIGHTS}) group by 1) l
      left join ({STREAKS}) s using (table_name, last_day)"""


CASES["green_streaks"] = STREAKS
CASES["green_streak_gate"] = streak_gate(3)
CASES["stability_gate"] = streak_gate(30)
CASES["diff_rate_gate"] = """
with r as (select event_type, ts::date as day, count(*) as q, count(*) filter (value > 250) as m from events group by all)
select r.event_type as table_name, count(*) as days_seen, count(*) filter (m::double / q * 100 < 1.5) as days_below,
  count(*) >= 14 and count(*) = count(*) filter (m::double / q * 100 < 1.5) as gate_open
from r join (select event_type, max(day) as last from r group by 1) l using (event_type)
where day > last - 14 group by 1"""
CASES["lag_alarm"] = """
with p as (select event_type, time_bucket(interval '1 hour', ts) as period_start, avg(value) as m from events group by all)
select a.event_type, a.period_start, round(a.m, 4) as measure from p a
join p b on b.event_type = a.event_type and b.period_start = a.period_start - interval '1 hour'
join p c on c.event_type = a.event_type and c.period_start = a.period_start - interval '2 hours'
where a.m > 50 and b.m > 50 and c.m > 50"""
CASES["drift_alarm"] = """
select event_type, time_bucket(interval '5 minutes', ts) as period_start, max(value / 100) as measure
from events group by 1, 2 having max(value / 100) > 1.0"""
CASES["failure_alarm"] = """
select time_bucket(interval '5 minutes', ts) as period_start, count(*) as measure
from events where event_type = 'error' group by 1"""
CASES["rows_per_hour"] = """
select event_type, time_bucket(interval '1 hour', ts) as hour, sum(floor(value)::bigint)::bigint as row_count
from events group by 1, 2"""
CASES["throughput_trend"] = """
select event_type as job, ts::date as day, count(*) as n_runs, round(avg(floor(value) / (event_id % 1000)), 4) as avg_seconds_per_row,
  round(quantile_disc(floor(value) / (event_id % 1000), 0.5), 4) as median_seconds_per_row
from events where event_id % 1000 > 0 group by 1, 2"""
CASES["latest_run_gate"] = """
select event_type as chain_id, strftime(ts, '%Y%m%d') as run_date, strftime(ts, '%H%M%S') as run_time, event_id,
  case when value < 60 then 'G' else 'R' end as status, value < 60 as may_extract
from events where event_type = 'purchase' order by run_date desc, run_time desc limit 1"""

# --- sources and sinks -----------------------------------------------------------------------

CASES["incremental_scan"] = "select * from orders where o_orderdate > timestamp '2000-12-31 00:00:00'"
CASES["advance_watermark"] = """
select count(*) as rows_read, count(*) as rows_written, max(o_orderdate) as watermark from orders"""
CASES["consumed_requests"] = """
select *, strftime(o_orderdate, '%Y%m') as request from orders where strftime(o_orderdate, '%Y%m') not in
  (select strftime(l_shipdate, '%Y%m') from lineitem where l_shipdate < date '1997-01-01')"""
CASES["parquet_scan"] = "select * from part"
CASES["csv_scan"] = MARA_SRC
CASES["staging_zone"] = LFA1
CASES["sidecars"] = """
select 'HANA:SAPSR3.MARA' as contract_fqn, 'incremental_merge' as load_strategy, 'MATNR' as partition_column,
  32::int as partition_num_chunks, count(*) as row_count, '2031-09-05T03:40:12+00:00' as extracted_at, 14::int as n_columns
from part"""
CASES["hour_partition_layout"] = """
select strftime(ts, '%Y-%m-%d') as dt, hour(ts)::int as hh, count(*) as n from events group by 1, 2"""
CASES["keyed_layout"] = MARA
CASES["clustered_layout"] = f"""
select year(_loaded_at)::int as year, count(*) as n, sum(total_price)::decimal(24,2) as total, max(order_key) as last_key, 0::bigint as overlapping_files
from ({LOADED}) group by 1"""
CASES["jdbc_range_scan"] = "select * from supplier"
SKEWED = """select o_orderkey, o_orderdate,
  case when o_orderkey % 3 = 0 then 7 when o_orderkey % 11 <> 0 then o_custkey * o_custkey end as o_custkey from orders"""
CASES["jdbc_even_scan"] = f"select *, 'key' as cut_by from ({SKEWED}) union all select *, 'day' from ({SKEWED}) where o_custkey > 7"
CASES["jdbc_hash_scan"] = "select * from supplier"
CASES["jdbc_key_range_scan"] = "select * from supplier"
CASES["jdbc_queue_scan"] = """
select o_custkey, o_orderkey, o_orderstatus from orders
where o_custkey not in (select c_custkey from customer where c_acctbal < 0)"""
CASES["jdbc_single_scan"] = "select * from supplier where s_nationkey > 10"
CASES["jdbc_bounds"] = "select count(*) as n, min(s_suppkey) as low, max(s_suppkey) as high from supplier"
CASES["jdbc_upsert"] = """
select * replace (case when s_nationkey = 3 then 99 else s_nationkey end as s_nationkey) from supplier
union all select * replace (-s_suppkey - 1 as s_suppkey) from supplier"""

# --- whole runs ------------------------------------------------------------------------------

CASES["run_table"] = MARA
CASES["run_table_late_rows"] = MARA
CASES["run_table_masked"] = KNA1_MASKED
CASES["run_many_ordered"] = f"""
select 1 as attempt, 'LFA1' as table_name, 'FAILED' as status, 0::bigint as n_rows
union all select 1, name, 'HELD', 0 from (values ('MARA'), ('ZPRICE_HISTORY')) t(name)
union all select 1, 'KNA1', 'SUCCEEDED', count(*) from customer
union all select 2, 'KNA1', 'SKIPPED', 0
union all select 2, 'LFA1', 'SUCCEEDED', count(*) from supplier
union all select 2, 'MARA', 'SUCCEEDED', count(*) from part
union all select 2, 'ZPRICE_HISTORY', 'SUCCEEDED', count(*) from ({PRICES})"""
CASES["run_many"] = " union all ".join(
    f"select 'batch-0905-{name}' as batch_id, count(*) as n_rows, 'SUCCEEDED' as status, count(*) as row_count from {table}"
    for name, table in (("MARA", "part"), ("KNA1", "customer"), ("LFA1", "supplier"))
)
CASES["run_table_bad_values"] = """
select 'gross_weight' as column_name, 'FAILED' as status, count(*) filter (p_partkey % 5 = 0) as lost_count, 'FAILED' as outcome, 0::bigint as loaded from part
union all select 'is_deletion_flag', 'WARNING', count(*) filter (p_partkey % 7 = 0), 'FAILED', 0 from part"""
CASES["run_rollback"] = """
select 'first' as batch_id, count(*) as n_rows, 'SUCCEEDED' as status, count(*) as "between" from supplier where s_suppkey % 2 = 0
union all select 'second', count(*), 'SUCCEEDED', (select count(*) from supplier where s_suppkey % 2 = 0) from supplier where s_suppkey % 2 <> 0"""
CASES["cdc_new_checkpoint"] = CASES["run_cdc"]
CASES["run_reports"] = """
select phase, layer, 'PASSED' as status
from (select unnest(['post_extract', 'post_load_operational', 'post_load_analytical']) as phase),
  (select unnest(['row_count', 'null_ratio', 'pk_uniqueness', 'checksum_bands', 'statistical_distribution']) as layer)"""
CASES["run_incremental_overall"] = f"""
select case when bool_or(status = 'FAILED') then 'FAILED' when bool_or(status = 'WARNING') then 'WARNING' else 'PASSED' end as overall_status,
  count(*) as layers, count(*) filter (status = 'FAILED') as failed, count(*) filter (status = 'WARNING') as warned
from ({CASES['run_incremental']})"""
CASES["quantile_rank_errors"] = " union all ".join(
    f"select '{c}' as column_name, quantile_cont({c}, 0.5) is not null as median_ok, quantile_cont({c}, 0.95) is not null as p95_ok from lineitem"
    for c in ("l_orderkey", "l_quantity", "l_extendedprice"))
CASES["phase_gates"] = f"""
select table_name, 'green_nights' as gate, gate_open from ({CASES['green_streak_gate']})
union all select table_name, 'diff_rate', gate_open from ({CASES['diff_rate_gate']})
union all select table_name, 'stable_days', gate_open from ({CASES['stability_gate']})
union all select event_type, 'prerequisites', case event_type when 'purchase' then 'signup' when 'click' then 'view' end is null
  or case event_type when 'purchase' then 'signup' when 'click' then 'view' end in (
    select event_type from (select event_type, ts::date as day, avg(case when value > 100 then 1.0 else 0.0 end) as share from events group by 1, 2) where share < 0.15)
  from (select distinct event_type from events)"""
