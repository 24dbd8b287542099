"""The driver's checked queries, one function per query name.

Each takes ``(spark, sf_dir)``, reads the driver tables (or data Spark derives
from them: the business tables of ``derived``, files written by the
round-trip queries into the shared checkpoint folder) and returns a lazy
DataFrame whose column names match ``oracle.ORACLE_SQL``. Similarities are
rounded to 6 digits and lists are rendered as sorted text on both sides.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import derived
from .functions.address import parse_address_line
from .functions.address_model import fit as fit_addresses
from .functions.casts import flags_to_double, nan_to_null
from .functions.text import clean_account_name, clean_german_road, split_house_number
from .operators.profile import merge_sketches, profile_sketches, profile_table, profile_tables
from .operators.state import ensure_all_keys, fill_null_update, not_in
from .operators.topk import top_k_per_group
from .plans.incremental import LinkStore, link_delta
from .plans.link import link, stage_firms
from .plans.matchers import MatcherRegistry, match_by_address, match_by_name
from .plans.refresh import DEALS_FLAG_COLUMNS, full_refresh as refresh_table, update_from_text
from .session import scratch_path
from .sources.archive import load_zip_exports, write_zip_export
from .sources.catalog import create_tables, ensure_crosswalk, profile_database, stored_profile, swap_table
from .sources.csv import load_csv_dump, read_typed_csv, type_counts, write_csv
from .sources.parts import read_parts, save_parts, update_parts
from .sources.publish import publish, read_current
from .sources.xml import load_xml_dump, write_xml

T = derived.table


def _text_table(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# -- names -------------------------------------------------------------------

def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned company keys of both systems."""
    firms = stage_firms(derived.firms(spark, sf))
    accounts = derived.accounts(spark, sf)
    left = firms.select(F.lit("firms").alias("system"), F.col("rec_id").alias("key"),
                        clean_account_name(F.coalesce("name", "kuerzel")).alias("clean_name"))
    right = accounts.select(F.lit("accounts").alias("system"), F.col("Id").alias("key"),
                            clean_account_name("Account_Name").alias("clean_name"))
    return left.unionByName(right)


def name_match(spark: SparkSession, sf: str) -> DataFrame:
    """M1 (flagship): best account per firm by cleaned name."""
    p = match_by_name(stage_firms(derived.firms(spark, sf)), derived.accounts(spark, sf))
    return p.select("rec_id", F.col("Id").alias("id"), F.round("sim", 6).alias("sim"),
                    "mc", "zc")


# -- addresses ---------------------------------------------------------------

def address_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed and cleaned address parts of both systems."""
    firms = derived.firms(spark, sf)
    accounts = derived.accounts(spark, sf)

    def parts(df, system, key, street, code):
        raw = F.concat(F.col(street), F.lit(", "), F.col(code), F.lit(", Deutschland"))
        p = parse_address_line(raw)
        hn = split_house_number(p["house_number"])
        return df.select(F.lit(system).alias("system"), F.col(key).alias("key"),
                         p["road"].alias("road"), p["house_number"].alias("house_number"),
                         p["postcode"].alias("postcode"),
                         clean_german_road(p["road"]).alias("road_cleaned"),
                         hn["num_1"].alias("house_num_1"), hn["num_2"].alias("house_num_2"))

    return parts(firms, "firms", "rec_id", "strasse", "plz").unionByName(
        parts(accounts, "accounts", "Id", "Billing_Street", "Billing_Code"))


def address_model(spark: SparkSession, sf: str) -> DataFrame:
    """F13 + F14 by the trained parser: lines in four orders, learnt from the lines of two thirds of the pages."""
    lines = derived.labelled_addresses(spark, sf)
    model = fit_addresses(lines.where(F.crc32(F.col("k").cast("string").cast("binary")) % 3 != 0))
    return lines.select("k", "line", model.parser()("line").alias("p")).select(
        "k", "line", "p.road", "p.house_number", "p.postcode", "p.city")


def _cached(*frames: DataFrame) -> list[DataFrame]:
    return [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]


def address_match(spark: SparkSession, sf: str) -> DataFrame:
    """M2: address matches of the firms the name matcher left unmatched."""
    # both matchers read both inputs: cache them while the query runs, then
    # keep only the (small) checkpointed result
    firms, accounts = _cached(stage_firms(derived.firms(spark, sf)), derived.accounts(spark, sf))
    try:
        by_name = match_by_name(firms, accounts).select("rec_id")
        unmatched = not_in(firms, "rec_id", by_name)
        p = match_by_address(unmatched, accounts)
        return p.select("rec_id", F.col("Id").alias("id"),
                        F.round("similarity", 6).alias("similarity")).checkpoint(eager=True)
    finally:
        firms.unpersist()
        accounts.unpersist()


# -- link state --------------------------------------------------------------

def link_waterfall(spark: SparkSession, sf: str) -> DataFrame:
    """M3-M6: the crosswalk after name, then address matching."""
    state, _ = link(derived.firms(spark, sf), derived.accounts(spark, sf))
    return state


def link_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """M3-M6 after deltas: a third of both systems first, then two deltas; equal to one run over all."""
    firms, accounts = derived.firms(spark, sf), derived.accounts(spark, sf)
    store = LinkStore(spark, scratch_path(spark, "link_store"))
    for part in (0, 1, 2):
        links = link_delta(store, firms.where(F.pmod(F.crc32(F.col("rec_id").cast("binary")), F.lit(3)) == part),
                           accounts.where(F.pmod(F.crc32(F.col("Id").cast("binary")), F.lit(3)) == part))
    return links


def match_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    """Totals and match rate of the link job."""
    state, summary = link(derived.firms(spark, sf), derived.accounts(spark, sf))
    return summary.select("total_firms", "matched_firms", "unmatched_firms",
                          F.round("match_rate", 6).alias("match_rate"))


def match_enabled_subset(spark: SparkSession, sf: str) -> DataFrame:
    """M4: the link job with only the address matcher enabled."""
    state, _ = link(derived.firms(spark, sf), derived.accounts(spark, sf),
                    enabled="address_match")
    return state


def ensure_all_keys_query(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + D1: the name links, completed with every other firm as NULL."""
    firms = stage_firms(derived.firms(spark, sf))
    state = match_by_name(firms, derived.accounts(spark, sf)).select(
        "rec_id", F.col("Id").alias("id_zoho"))
    return ensure_all_keys(state, firms)


def not_in_with_null(spark: SparkSession, sf: str) -> DataFrame:
    """NOT IN against a plain key list, one with a NULL, and an empty one."""
    cust = T(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(24)).alias("nkey"))
    nation = T(spark, sf, "nation")
    plain = nation.select(F.col("n_regionkey").alias("k"))
    with_null = nation.select(F.nullif(F.col("n_regionkey"), F.lit(4)).alias("k"))
    empty = nation.where(F.col("n_name").isNull()).select(F.col("n_regionkey").alias("k"))
    out = None
    for variant, keys in (("plain", plain), ("with_null", with_null), ("empty", empty)):
        part = not_in(cust, "nkey", keys, "k").select(
            F.lit(variant).alias("variant"), "c_custkey", "nkey")
        out = part if out is None else out.unionByName(part)
    return out


def fill_null_update_query(spark: SparkSession, sf: str) -> DataFrame:
    """Proposals fill only the NULL links."""
    firms = derived.firms(spark, sf)
    k = F.col("rec_id").cast("long")
    state = firms.select("rec_id", F.when(k % 3 == 0, F.lit(None).cast("string"))
                         .otherwise(F.concat(F.lit("old-"), "rec_id")).alias("id_zoho"))
    proposals = firms.select("rec_id", F.concat(F.lit("new-"), "rec_id").alias("Id"))
    return fill_null_update(state, proposals)


# -- updates and refresh -----------------------------------------------------

def update_by_key_query(spark: SparkSession, sf: str) -> DataFrame:
    """M8: orders' customer keys updated from text, some not castable."""
    orders = T(spark, sf, "orders")
    target = orders.select("o_orderkey", "o_custkey")
    prio = F.col("o_orderpriority")
    updates = orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(prio == "1-URGENT", F.lit("abc")).when(prio == "2-HIGH", F.lit("12.5"))
         .otherwise((F.col("o_custkey") + 1).cast("string")).alias("o_custkey"))
    return update_from_text(target, updates, "o_orderkey", ["o_custkey"], flag="updated")


def deals_like(spark: SparkSession, sf: str) -> DataFrame:
    """A deals-shaped export derived from ``labels``: boolean flags."""
    lab = T(spark, sf, "labels")
    return lab.select("doc_id",
                      (F.col("quality") == 1).alias("via_angebote"),
                      (F.col("toxic") == 1).alias("Locked__s"),
                      ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("AP_ist_Entscheider"))


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """M7: refresh a table twice (region, then the deals export); the
    published table holds the second input only, flags as double."""
    base = scratch_path(spark, "full_refresh")
    refresh_table(T(spark, sf, "region"), base)
    refresh_table(deals_like(spark, sf), base, DEALS_FLAG_COLUMNS)
    out = read_current(spark, base)
    return out.select(*[F.col(c).alias(c.lower()) for c in out.columns])


def snapshot_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two published versions; readers see the newest."""
    base = scratch_path(spark, "publish")
    publish(T(spark, sf, "supplier"), base, "v1")
    publish(T(spark, sf, "customer"), base, "v2")
    return read_current(spark, base)


def update_touched_parts(spark: SparkSession, sf: str) -> DataFrame:
    """J6 + D3: orders in parts; an update of few keys rewrites their parts only; equal to ``update_by_key``."""
    base = scratch_path(spark, "order_parts")
    orders = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    save_parts(orders, base, "o_orderkey")
    key = F.col("o_orderkey")
    updates = orders.where(key % 1000 == 7).select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"))
    gone = orders.where(key % 5000 == 11).select((-key).alias("o_orderkey"), F.lit(0).cast("long").alias("o_custkey"))
    update_parts(spark, base, updates.unionByName(gone), ["o_custkey"])
    return read_parts(spark, base)


def _database(spark: SparkSession, purpose: str) -> str:
    """A database of the session catalog whose tables lie in the shared checkpoint folder."""
    path = scratch_path(spark, purpose)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"create database {name} location '{path}'")
    return name


def catalog_publish(spark: SparkSession, sf: str) -> DataFrame:
    """S8 + S11 + S16 + S19: a catalog table created, then replaced by rename with rows made from itself."""
    database = _database(spark, "catalog_publish")
    create_tables({"customer": T(spark, sf, "customer").where("c_custkey % 2 = 0")}, database)
    ensure_crosswalk(spark, database)
    swap_table(spark.table(f"{database}.customer").unionByName(T(spark, sf, "customer").where("c_custkey % 2 = 1")),
               database, "customer")
    swap_table(spark.table(f"{database}.customer").withColumn("c_acctbal", -F.col("c_acctbal")), database, "customer")
    return spark.table(f"{database}.customer")


def catalog_drop_empty(spark: SparkSession, sf: str) -> DataFrame:
    """D5 + D6 + P13 + M9: a database profiled into a table of its own, tables without rows dropped on request."""
    database = _database(spark, "catalog_profile")
    supplier = T(spark, sf, "supplier")
    create_tables({"supplier": supplier, "nobody": supplier.where("s_suppkey < -1"), "nation": T(spark, sf, "nation")}, database)
    dropped = profile_database(spark, database, drop_empty=True)
    left = sorted(t.name for t in spark.catalog.listTables(database))
    return stored_profile(spark, database).select(
        "table_name", "column_name", "total_rows", "non_null", "distinct_values", "list_distinct_values",
        F.lit(",".join(dropped)).alias("dropped"), F.lit(",".join(left)).alias("tables"))


def profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """A3 + A5 + M9: sketches of two versions of orders, merged; the estimates held against exact counts."""
    orders = T(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("2-HIGH")))
    path = scratch_path(spark, "sketches")
    for part in (0, 1):
        profile_sketches(orders.where(F.col("o_orderkey") % 2 == part), "orders").write.mode("append").parquet(path)
    merged = merge_sketches(spark.read.parquet(path))
    exact = profile_table(orders, "orders").select("column_name", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.03 * F.col("exact")
    return merged.join(exact, "column_name").select("table_name", "column_name", "total_rows", "non_null",
                                                    F.col("exact").alias("distinct_values"), near.alias("within_3_percent"))


def float_flags(spark: SparkSession, sf: str) -> DataFrame:
    """P7 + P8: boolean flags (some NULL) to double, NaN to NULL."""
    lab = T(spark, sf, "labels")
    hole = F.col("doc_id") % 7 == 0
    df = lab.select(
        "doc_id",
        F.when(hole, F.lit(None).cast("boolean")).otherwise(F.col("quality") == 1).alias("quality"),
        F.when(hole, F.lit(None).cast("boolean")).otherwise(F.col("toxic") == 1).alias("toxic"),
        F.when(hole, F.lit(float("nan"))).otherwise(F.col("quality") + 0.5).alias("score"))
    return nan_to_null(flags_to_double(df, ["quality", "toxic"]), ["score"])


def drop_any_null(spark: SparkSession, sf: str) -> DataFrame:
    """Firms with no NULL in any column."""
    return derived.firms(spark, sf).na.drop("any")


# -- profile and top-k -------------------------------------------------------

def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    """M9: column profile of part (with NULLs injected), nation, customer."""
    part = T(spark, sf, "part").withColumns({
        "p_brand": F.nullif(F.col("p_brand"), F.lit("Brand#2")),
        "z": F.lit(None).cast("string")})
    prof = profile_tables({"part": part, "nation": T(spark, sf, "nation"),
                           "customer": T(spark, sf, "customer")})
    return prof.select("table_name", "column_name", "total_rows", "non_null",
                       "distinct_values",
                       F.array_join("list_distinct_values", "|", "<null>")
                       .alias("list_distinct_values"))


def best_match_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's largest order (ties: smallest order key)."""
    orders = T(spark, sf, "orders")
    best = top_k_per_group(orders, ["o_custkey"],
                           [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], k=1)
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


# -- file round trips ----------------------------------------------------------

def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S10 + F17 + M11: customer written as CSV with NA-like segments, loaded
    back as an all-text table."""
    cust = T(spark, sf, "customer")
    r = F.col("c_custkey") % 10
    seg = (F.when(r == 0, "NA").when(r == 1, "null").when(r == 2, "na").when(r == 3, "Nil")
           .when(r == 4, "").otherwise(F.col("c_mktsegment")))
    folder = scratch_path(spark, "csv_dump")
    write_csv(_text_table(cust.withColumn("c_mktsegment", seg)), f"{folder}/customer.csv")
    return load_csv_dump(spark, folder)["customer"]


def csv_detected_types(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV with mixed columns, read back as text, types detected from all rows."""
    key = F.col("o_orderkey")
    orders = T(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").cast("date").cast("string").alias("o_day"),
        F.when(key % 7 == 0, F.lit(None).cast("string")).otherwise((key % 2 == 0).cast("string")).alias("even"),
        F.when(key % 5 == 0, F.concat((key % 100).cast("string"), F.lit(".5e1"))).otherwise(key.cast("string")).alias("number"),
        F.when(key % 3 == 0, F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" 10:20:30")))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("moment"),
        F.when(key % 11 == 0, "2024-02-30").otherwise("2024-02-28").alias("no_day"),
        F.when(key % 1000 == 1, "n/a?").otherwise(key.cast("string")).alias("late"), F.lit(None).cast("string").alias("nothing"))
    folder = scratch_path(spark, "csv_types")
    write_csv(_text_table(orders), f"{folder}/orders.csv")
    return type_counts(load_csv_dump(spark, folder, multi_line=False)["orders"])


def zip_export_load(spark: SparkSession, sf: str) -> DataFrame:
    """Customer landed as zipped CSV exports, loaded as text."""
    folder = scratch_path(spark, "zip_landing")
    write_zip_export(_text_table(T(spark, sf, "customer")), folder, "customer")
    return load_zip_exports(spark, folder)["customer"]


def zip_multi_module(spark: SparkSession, sf: str) -> DataFrame:
    """Two modules in one landing; suppliers in two archives whose members have different
    headers, customers of no row at all beside their header."""
    folder = scratch_path(spark, "zip_modules")
    sup = _text_table(T(spark, sf, "supplier"))
    even = F.col("s_suppkey").cast("long") % 2 == 0
    write_zip_export(sup.where(even), folder, "Accounts")
    write_zip_export(sup.where(~even).select("s_name", "s_suppkey"), folder, "Accounts")
    write_zip_export(_text_table(T(spark, sf, "customer")).limit(0), folder, "Contacts")
    tables = load_zip_exports(spark, folder)
    accounts, contacts = tables["Accounts"], tables["Contacts"]
    names = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    # the empty module gives its columns and no row
    return accounts.select(*names).unionByName(contacts.select(
        *[F.col(c).alias(n) for c, n in zip(("c_custkey", "c_name", "c_nationkey", "c_acctbal"), names)]))


def xml_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """A file whose rows are child tags, with a nested and a repeated element; one whose child
    tags also occur deeper; rows inside rows; a document without rows, which gives its columns."""
    folder = scratch_path(spark, "xml_shapes")
    cust = _text_table(T(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"))
    child = cust.select("c_custkey", F.struct(F.col("c_name").alias("_VALUE"), F.lit("x").alias("part")).alias("c_name"),
                        F.array("c_nationkey", F.lit("again")).alias("c_nationkey"))
    (child.write.format("xml").option("rowTag", "customer").option("rootTag", 'dump name="child"').save(f"{folder}/child"))
    deep = cust.select("c_custkey", "c_name", F.struct(F.lit("deep").alias("entry")).alias("c_nationkey"),
                       F.struct("c_custkey").alias("entry"))
    (deep.write.format("xml").option("rowTag", "entry").option("rootTag", 'dump name="direct"').save(f"{folder}/direct"))
    key = F.col("c_custkey").cast("long")
    outer = cust.where(key % 2 == 0).alias("o").join(
        cust.where(key % 2 == 1).alias("i"), F.col("o.c_custkey").cast("long") + 1 == F.col("i.c_custkey").cast("long"), "full")
    nested = outer.select("o.c_custkey", "o.c_name", F.struct(F.struct("i.c_custkey", "i.c_name").alias("Row")).alias("more"))
    (nested.write.format("xml").option("rowTag", "Row").option("rootTag", 'dump name="inner"').save(f"{folder}/inner"))
    # children that do not all have children are no rows: a table without rows, with the first child's columns
    no_rows = cust.agg(*[F.max(c).alias(c) for c in cust.columns]).withColumn(
        "cells", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "cells", *[F.when(F.col("cells") == 1, F.col(c)).alias(c) for c in cust.columns])
    (no_rows.coalesce(1).sortWithinPartitions("cells").drop("cells").write.format("xml").option("rowTag", "entry")
     .option("rootTag", 'dump name="none"').save(f"{folder}/none"))
    tables = load_xml_dump(spark, [f"{folder}/child", f"{folder}/direct", f"{folder}/inner", f"{folder}/none"])
    # the nested element's own text runs up to the indentation before its child
    own = F.regexp_replace("c_name", r"\s+$", "").alias("c_name")
    rows = tables["child"].select(F.lit("child").alias("file"), "c_custkey", own, "c_nationkey")
    direct = tables["direct"].select(F.lit("direct").alias("file"), "c_custkey", "c_name", "c_nationkey")
    inner = tables["inner"].where("c_custkey is not null").select(
        F.lit("inner").alias("file"), "c_custkey", "c_name", F.lit(None).cast("string").alias("c_nationkey"))
    none = tables["none"].select(F.lit("none").alias("file"), "c_custkey", "c_name", "c_nationkey")
    return rows.unionByName(direct).unionByName(inner).unionByName(none)


def update_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """M8 + S12 fed from a file: orders updated from a CSV of text ids, some not castable, some
    decimals of many digits."""
    folder = scratch_path(spark, "update_csv")
    orders = T(spark, sf, "orders")
    key = F.col("o_orderkey")
    value = (F.when(key % 5 == 0, F.lit("n/a?")).when(key % 5 == 1, F.concat((key % 1000).cast("string"), F.lit(".49999999999")))
             .when(key % 5 == 2, F.concat((key % 1000).cast("string"), F.lit(".5")))
             .when(key % 5 == 3, F.lit("-1e2")).otherwise(key.cast("string")))
    write_csv(orders.where(F.col("o_orderstatus") == "O").select(
        key.cast("string").alias("o_orderkey"), value.alias("o_custkey")), f"{folder}/orders.csv")
    updates = read_typed_csv(spark, f"{folder}/orders.csv", "o_orderkey string, o_custkey string")
    return update_from_text(orders.select("o_orderkey", "o_custkey"), updates, "o_orderkey", ["o_custkey"], flag="updated")


def refresh_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """M7 fed from a file: the deals export as CSV, checked, flags to double, published."""
    folder = scratch_path(spark, "refresh_csv")
    write_csv(_text_table(deals_like(spark, sf)), f"{folder}/deals.csv")
    table = load_csv_dump(spark, folder)["deals"]
    refresh_table(table, f"{folder}/published", DEALS_FLAG_COLUMNS)
    out = read_current(spark, f"{folder}/published")
    return out.select(*[F.col(c).alias(c.lower()) for c in out.columns])


def match_custom(spark: SparkSession, sf: str) -> DataFrame:
    """A matcher of the user's own (equal postcodes, smallest account) in front of the defaults,
    name matching registered but switched off."""
    def by_postcode(firms: DataFrame, accounts: DataFrame) -> DataFrame:
        codes = accounts.where("Billing_Code is not null").groupBy("Billing_Code").agg(F.min("Id").alias("Id"))
        return firms.join(codes, F.col("plz") == F.col("Billing_Code")).select("rec_id", "Id")

    registry = MatcherRegistry()
    registry.register("postcode", by_postcode, "Equal postcodes")
    registry.register("name_match", match_by_name, "Off", enabled=False)
    state, _ = link(derived.firms(spark, sf), derived.accounts(spark, sf), registry=registry,
                    enabled="postcode,name_match")
    return state


def xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S1-S7 + M10: supplier written in the dump layout and loaded back."""
    folder = scratch_path(spark, "xml_dump")
    write_xml(T(spark, sf, "supplier"), f"{folder}/supplier", "supplier")
    return load_xml_dump(spark, f"{folder}/supplier")["supplier"]


def xml_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """S5 + S18: one table in two files; ``s_acctbal`` exists only for even
    keys, so it is NULL for the odd ones after the load."""
    sup = T(spark, sf, "supplier")
    folder = scratch_path(spark, "xml_drift")
    even = F.col("s_suppkey") % 2 == 0
    write_xml(sup.where(even), f"{folder}/even", "supplier")
    write_xml(sup.where(~even).drop("s_acctbal"), f"{folder}/odd", "supplier",
              root_tag="suppliers")
    return load_xml_dump(spark, [f"{folder}/even", f"{folder}/odd"])["supplier"]


QUERIES = {
    "clean_names": clean_names,
    "name_match": name_match,
    "address_parts": address_parts,
    "address_model": address_model,
    "address_match": address_match,
    "link_waterfall": link_waterfall,
    "link_incremental": link_incremental,
    "match_summary": match_summary_query,
    "match_enabled_subset": match_enabled_subset,
    "ensure_all_keys": ensure_all_keys_query,
    "not_in_with_null": not_in_with_null,
    "update_by_key": update_by_key_query,
    "fill_null_update": fill_null_update_query,
    "profile_columns": profile_columns,
    "drop_any_null": drop_any_null,
    "float_flags": float_flags,
    "xml_roundtrip": xml_roundtrip,
    "xml_schema_drift": xml_schema_drift,
    "csv_roundtrip": csv_roundtrip,
    "csv_detected_types": csv_detected_types,
    "zip_export_load": zip_export_load,
    "zip_multi_module": zip_multi_module,
    "xml_shapes": xml_shapes,
    "update_from_csv": update_from_csv,
    "refresh_from_csv": refresh_from_csv,
    "match_custom": match_custom,
    "full_refresh": full_refresh,
    "snapshot_publish": snapshot_publish,
    "update_touched_parts": update_touched_parts,
    "catalog_publish": catalog_publish,
    "catalog_drop_empty": catalog_drop_empty,
    "profile_merged": profile_merged,
    "best_match_topk": best_match_topk,
}
