"""DuckDB SQL for each checked query (the correctness oracle).

Every string runs on DuckDB with the driver tables registered as views. Where
DuckDB has the reference's own function (``jaro_winkler_similarity``,
``strip_accents``, RE2 regexes, ``NOT IN``, ``QUALIFY``) it is used directly, so
the Spark side is checked against the real semantics, not a re-statement.
"""

from __future__ import annotations

from .derived import SQL_ACCOUNTS, SQL_FIRMS
from .functions.address import HOUSE_NUMBER_PATTERN
from .functions.text import LATIN_EXTRA, LEGAL_FORMS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean(e: str) -> str:
    words = "|".join(LEGAL_FORMS)
    return (f"regexp_replace(regexp_replace(lower(strip_accents(replace({e}, '&#38;', ''))), "
            f"'\\b({words})\\b', '', 'g'), '[^a-z0-9]', '', 'g')")


def translit(e: str) -> str:
    out = f"strip_accents({e})"
    for k, v in LATIN_EXTRA.items():
        out = f"replace({out}, {q(k)}, {q(v)})"
    return out


def road_cleaned(road: str) -> str:
    t = f"regexp_replace(lower({road}), '^\\s+|\\s+$', '', 'g')"
    t = f"replace({t}, 'ß', 'ss')"
    t = f"regexp_replace({t}, '(str\\.|str$|str\\s|straße|strasse)', '', 'g')"
    t = f"regexp_replace({translit(t)}, '[^a-z0-9]', '', 'g')"
    return f"(case when {road} is null or {road} = '' then null else {t} end)"


def address_cols(raw: str) -> str:
    """road, house_number, postcode, road_cleaned, house_num_1, house_num_2."""
    p = q(HOUSE_NUMBER_PATTERN)
    seg = f"trim(regexp_extract({raw}, '^([^,]*)', 1))"
    road = f"lower(case when regexp_matches({seg}, {p}) then regexp_extract({seg}, {p}, 1) else {seg} end)"
    hn = f"lower(case when regexp_matches({seg}, {p}) then regexp_extract({seg}, {p}, 2) end)"
    postcode = f"nullif(regexp_extract({raw}, '\\b(\\d{{5}})\\b', 1), '')"
    parts = f"string_split_regex({hn}, '[-/]')"
    blank = f"({hn} is null or {hn} = '')"
    h1 = f"(case when {blank} then null else nullif(regexp_replace({parts}[1], '\\D', '', 'g'), '') end)"
    h2 = (f"(case when {blank} or len({parts}) < 2 then null "
          f"else nullif(regexp_replace({parts}[2], '\\D', '', 'g'), '') end)")
    return (f"{road} as road, {hn} as house_number, {postcode} as postcode, "
            f"{road_cleaned(road)} as road_cleaned, {h1} as house_num_1, {h2} as house_num_2")


BASE = f"firms as ({SQL_FIRMS}), accounts as ({SQL_ACCOUNTS})"

# best account per firm by cleaned name (firms staged: name/kuerzel trimmed)
NAME_MATCH_CTE = f"""
m as (select rec_id, {clean('coalesce(trim(name), trim(kuerzel))')} as mc from firms),
z as (select Id, {clean('Account_Name')} as zc from accounts),
nm_all as (select m.rec_id, z.Id, m.mc, z.zc, jaro_winkler_similarity(m.mc, z.zc) as sim
           from m join z on m.mc = z.zc or jaro_winkler_similarity(m.mc, z.zc) > 0.95),
nm as (select * from nm_all qualify row_number() over (partition by rec_id order by sim desc, Id) = 1)"""


def address_match_cte(unmatched_pred: str) -> str:
    return f"""
fa0 as (select rec_id, trim(name) as name, plz, strasse from firms
        where rec_id is not null and name is not null and plz is not null and strasse is not null
          and {unmatched_pred}),
fa as (select *, {address_cols("strasse || ', ' || plz || ', Deutschland'")} from fa0),
aa0 as (select Id, Account_Name, Billing_Code, Billing_Street from accounts
        where Id is not null and Account_Name is not null and Billing_Code is not null
          and Billing_Street is not null),
aa as (select *, {address_cols("Billing_Street || ', ' || Billing_Code || ', Deutschland'")} from aa0),
aj as (select fa.rec_id, aa.Id, {clean('fa.name')} as fc, {clean('aa.Account_Name')} as ac
       from fa join aa on fa.road_cleaned = aa.road_cleaned and fa.plz = aa.postcode
        and (fa.house_number = aa.house_number or fa.house_num_1 = aa.house_num_1
             or fa.house_num_2 = aa.house_num_2)),
aj2 as (select rec_id, Id, jaro_winkler_similarity(fc, ac) as similarity, fc, ac from aj),
am as (select * from aj2 where similarity > 0.7 or contains(ac, fc) or contains(fc, ac)
       qualify row_number() over (partition by rec_id order by similarity desc, Id) = 1)"""


WATERFALL_CTE = f"""{BASE}, {NAME_MATCH_CTE},
{address_match_cte("rec_id not in (select rec_id from nm)")},
wf as (select f.rec_id, coalesce(nm.Id, am.Id) as id_zoho from firms f
       left join nm on f.rec_id = nm.rec_id left join am on f.rec_id = am.rec_id)"""


def _profile_sql(table: str, source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        v = f"cast({c} as varchar)"
        lst = (f"case when count(distinct {v}) < 30 then concat_ws('|', "
               f"string_agg(distinct {v}, '|' order by {v}), "
               f"case when count(*) > count({v}) then '<null>' end) end")
        parts.append(
            f"select '{table}' as table_name, '{c}' as column_name, count(*) as total_rows, "
            f"count({v}) as non_null, count(distinct {v}) as distinct_values, "
            f"{lst} as list_distinct_values from {source}")
    return "\nunion all\n".join(parts)


PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "z"]
NATION_COLUMNS = ["n_nationkey", "n_name", "n_regionkey"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

ORACLE_SQL = {
    "clean_names": f"""with {BASE}
select 'firms' as system, rec_id as key, {clean('coalesce(trim(name), trim(kuerzel))')} as clean_name from firms
union all
select 'accounts', Id, {clean('Account_Name')} from accounts""",

    "name_match": f"""with {BASE}, {NAME_MATCH_CTE}
select rec_id, Id as id, round(sim, 6) as sim, mc, zc from nm""",

    "address_parts": f"""with {BASE}
select 'firms' as system, rec_id as key, {address_cols("strasse || ', ' || plz || ', Deutschland'")} from firms
union all
select 'accounts', Id, {address_cols("Billing_Street || ', ' || Billing_Code || ', Deutschland'")} from accounts""",

    "address_match": f"""with {BASE}, {NAME_MATCH_CTE},
{address_match_cte("rec_id not in (select rec_id from nm)")}
select rec_id, Id as id, round(similarity, 6) as similarity from am""",

    "link_waterfall": f"""with {WATERFALL_CTE}
select rec_id, id_zoho from wf""",

    "match_summary": f"""with {WATERFALL_CTE}
select count(*) as total_firms, count(id_zoho) as matched_firms,
       count(*) - count(id_zoho) as unmatched_firms,
       round(case when count(*) > 0 then count(id_zoho) * 100.0 / count(*) else 0 end, 6) as match_rate
from wf""",

    "match_enabled_subset": f"""with {BASE}, {address_match_cte("true")}
select f.rec_id, am.Id as id_zoho from firms f left join am on f.rec_id = am.rec_id""",

    "ensure_all_keys": f"""with {BASE}, {NAME_MATCH_CTE}
select rec_id, Id as id_zoho from nm
union all
select rec_id, null from firms where rec_id not in (select rec_id from nm)""",

    "not_in_with_null": """with c as (select c_custkey, nullif(c_nationkey, 24) as nkey from customer)
select 'plain' as variant, c_custkey, nkey from c
 where nkey not in (select n_regionkey from nation)
union all
select 'with_null', c_custkey, nkey from c
 where nkey not in (select nullif(n_regionkey, 4) from nation)
union all
select 'empty', c_custkey, nkey from c
 where nkey not in (select n_regionkey from nation where n_name is null)""",

    "update_by_key": """with u as (
  select try_cast(cast(o_orderkey as varchar) as bigint) as k,
         try_cast(case o_orderpriority when '1-URGENT' then 'abc' when '2-HIGH' then '12.5'
                  else cast(o_custkey + 1 as varchar) end as bigint) as v
  from orders where o_orderstatus = 'F')
select o.o_orderkey, case when u.k is not null then u.v else o.o_custkey end as o_custkey,
       u.k is not null as updated
from orders o left join u on o.o_orderkey = u.k""",

    "fill_null_update": f"""with {BASE},
s as (select rec_id, case when cast(rec_id as bigint) % 3 = 0 then null else concat('old-', rec_id) end as id_zoho from firms),
p as (select rec_id, concat('new-', rec_id) as Id from firms)
select s.rec_id, coalesce(s.id_zoho, p.Id) as id_zoho from s left join p on s.rec_id = p.rec_id""",

    "profile_columns": "\nunion all\n".join([
        _profile_sql("part", "(select p_partkey, p_name, nullif(p_brand, 'Brand#2') as p_brand, p_type, "
                             "p_size, p_retailprice, cast(null as varchar) as z from part)", PART_COLUMNS),
        _profile_sql("nation", "nation", NATION_COLUMNS),
        _profile_sql("customer", "customer", CUSTOMER_COLUMNS)]),

    "drop_any_null": f"""with {BASE}
select * from firms where rec_id is not null and name is not null and kuerzel is not null
  and plz is not null and strasse is not null""",

    "float_flags": """select doc_id,
  case when doc_id % 7 = 0 then null else cast(quality = 1 as double) end as quality,
  case when doc_id % 7 = 0 then null else cast(toxic = 1 as double) end as toxic,
  case when doc_id % 7 = 0 then null else cast(quality as double) + 0.5 end as score
from labels""",

    "xml_roundtrip": """select cast(s_suppkey as varchar) as s_suppkey, s_name,
  cast(s_nationkey as varchar) as s_nationkey, cast(s_acctbal as varchar) as s_acctbal
from supplier""",

    "xml_schema_drift": """select cast(s_suppkey as varchar) as s_suppkey, s_name,
  cast(s_nationkey as varchar) as s_nationkey,
  case when s_suppkey % 2 = 0 then cast(s_acctbal as varchar) end as s_acctbal
from supplier""",

    "csv_roundtrip": """select cast(c_custkey as varchar) as c_custkey, c_name,
  cast(c_nationkey as varchar) as c_nationkey, cast(c_acctbal as varchar) as c_acctbal,
  case c_custkey % 10 when 0 then null when 1 then null when 2 then 'na' when 3 then 'Nil'
       when 4 then null else c_mktsegment end as c_mktsegment
from customer""",

    "zip_export_load": """select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
  cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer""",

    "zip_multi_module": """select cast(s_suppkey as varchar) as s_suppkey, s_name,
  case when s_suppkey % 2 = 0 then cast(s_nationkey as varchar) end as s_nationkey,
  case when s_suppkey % 2 = 0 then cast(s_acctbal as varchar) end as s_acctbal
from supplier""",

    "xml_shapes": """select 'child' as file, cast(c_custkey as varchar) as c_custkey, c_name,
  cast(c_nationkey as varchar) as c_nationkey from customer
union all
select 'direct', cast(c_custkey as varchar), c_name, null from customer
union all
select 'inner', cast(c_custkey as varchar), c_name, null from customer""",

    "update_from_csv": """select o_orderkey, case when o_orderstatus = 'O' then
    case o_orderkey % 5 when 0 then null when 1 then o_orderkey % 1000 when 2 then o_orderkey % 1000 + 1
         when 3 then -100 else o_orderkey end else o_custkey end as o_custkey,
  o_orderstatus = 'O' as updated
from orders""",

    "refresh_from_csv": """select cast(doc_id as varchar) as doc_id, cast(quality = 1 as double) as via_angebote,
  cast(toxic = 1 as double) as locked__s, cast(quality = 1 and toxic = 0 as double) as ap_ist_entscheider
from labels""",

    "match_custom": f"""with {BASE},
c as (select Billing_Code, min(Id) as Id from accounts where Billing_Code is not null group by Billing_Code)
select rec_id, c.Id as id_zoho from firms left join c on plz = Billing_Code""",

    "full_refresh": """select doc_id, cast(quality = 1 as double) as via_angebote,
  cast(toxic = 1 as double) as locked__s,
  cast(quality = 1 and toxic = 0 as double) as ap_ist_entscheider
from labels""",

    "snapshot_publish": "select * from customer",

    "best_match_topk": """select o_custkey, o_orderkey, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1""",
}

# two deltas, merged by the best match of either: the links of one run over everything
ORACLE_SQL["link_incremental"] = ORACLE_SQL["link_waterfall"]


def _detected_types() -> str:
    """Counts of values that have a type, per column, by form and try_cast; the first type that all values have."""
    forms = {  # fixed values
        "boolean": "(?i)(true|false)", "bigint": "[+-]?[0-9]{1,18}",
        "double": r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?", "date": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
        "timestamp": r"[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?"}
    columns = {
        "o_orderkey": "cast(o_orderkey as varchar)", "o_totalprice": "cast(o_totalprice as varchar)", "o_orderstatus": "o_orderstatus",
        "o_day": "cast(cast(o_orderdate as date) as varchar)",
        "even": "case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 2 = 0 as varchar) end",
        "number": "case when o_orderkey % 5 = 0 then concat(o_orderkey % 100, '.5e1') else cast(o_orderkey as varchar) end",
        "moment": "case when o_orderkey % 3 = 0 then concat(cast(o_orderdate as date), ' 10:20:30') "
                  "else cast(cast(o_orderdate as date) as varchar) end",
        "no_day": "case when o_orderkey % 11 = 0 then '2024-02-30' else '2024-02-28' end",
        "late": "case when o_orderkey % 1000 = 1 then 'n/a?' else cast(o_orderkey as varchar) end",
        "nothing": "cast(null as varchar)"}
    counts = ", ".join(f"count(*) filter (regexp_full_match(v, '{form}') and try_cast(v as {name}) is not null) as n_{name}"
                       for name, form in forms.items())
    cases = " ".join(f"when n_{name} = n_rows - n_null then '{name}'" for name in forms)
    parts = "\nunion all\n".join(f"select '{c}' as column_name, count(*) as n_rows, count(*) filter (v is null) as n_null, {counts} "
                                  f"from (select {v} as v from orders)" for c, v in columns.items())
    return f"select *, case when n_rows = n_null then 'string' {cases} else 'string' end as detected from ({parts})"


ORACLE_SQL["csv_detected_types"] = _detected_types()

ORACLE_SQL["update_touched_parts"] = """select o_orderkey, o_custkey + case when o_orderkey % 1000 = 7 then 1 else 0 end as o_custkey,
  o_orderstatus from orders"""

ORACLE_SQL["catalog_publish"] = """select c_custkey, c_name, c_nationkey, -c_acctbal as c_acctbal, c_mktsegment from customer"""

ORACLE_SQL["catalog_drop_empty"] = f"""select *, 'nobody' as dropped, 'nation,supplier,table_column_stats' as tables from (
{_profile_sql("supplier", "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])}
union all
{_profile_sql("nation", "nation", NATION_COLUMNS)})"""

ORACLE_SQL["profile_merged"] = " union all ".join(
    f"select 'orders' as table_name, '{c}' as column_name, count(*) as total_rows, count({v}) as non_null, "
    f"count(distinct {v}) as distinct_values, true as within_3_percent from orders"
    for c, v in [(c, c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")]
    + [("o_orderpriority", "nullif(o_orderpriority, '2-HIGH')")])

ORACLE_SQL["address_model"] = """with a as (
  select page_id as k, ['Hauptstraße', 'Bahnhofstr.', 'Am Alten Markt', 'Müllerweg', 'Lange Gasse', 'Lindenallee'][page_id % 6 + 1] as road,
         (page_id % 90 + 1)::varchar || case page_id % 3 when 0 then '-' || (page_id % 90 + 3)::varchar when 1 then 'a' else '' end as number,
         lpad(((page_id * 7919) % 99999)::varchar, 5, '0') as code,
         ['Berlin', 'Bad Homburg', 'Köln', 'Frankfurt am Main', 'Ulm'][page_id % 5 + 1] as city
  from pages)
select k, case k % 4 when 0 then concat(road, ' ', number, ', ', code, ', Deutschland')
                     when 1 then concat(road, ' ', number, ', ', code, ' ', city, ', Deutschland')
                     when 2 then concat(code, ' ', city, ', ', road, ' ', number) else concat(city, ', ', road) end as line,
       lower(road) as road, case when k % 4 < 3 then number end as house_number, case when k % 4 < 3 then code end as postcode,
       case when k % 4 > 0 then lower(city) end as city
from a"""
