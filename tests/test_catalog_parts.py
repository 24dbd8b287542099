"""Tables in parts, tables of the session catalog, mergeable profiles."""
import pytest
from pyspark.sql import functions as F

from conftest import rows
from linkwright.operators.profile import merge_sketches, profile_sketches, profile_table
from linkwright.operators.state import update_by_key
from linkwright.sources.catalog import (create_tables, ensure_crosswalk, profile_database, stored_profile, swap_table)
from linkwright.sources.parts import part_versions, read_parts, save_parts, update_parts


def test_update_rewrites_touched_parts_only(spark, tmp_path):
    base = str(tmp_path / "t")
    table = spark.range(500).selectExpr("id", "cast(id as string) as v", "id % 3 as w").unionByName(
        spark.createDataFrame([(None, "none", 1)], "id long, v string, w long"))
    save_parts(table, base, "id", parts=16)
    before = part_versions(spark, base)
    updates = spark.createDataFrame([(7, "x"), (8, None), (9999, "no such key"), (None, "no key")], "id int, v string")
    touched = update_parts(spark, base, updates, ["v"])
    after = part_versions(spark, base)
    assert 0 < len(touched) <= 3
    assert {p for p in after if after[p] != before[p]} == set(touched) and set(after) == set(before)
    assert rows(read_parts(spark, base)) == rows(update_by_key(table, updates, "id", ["v"]))
    assert update_parts(spark, base, updates.where("id is null"), ["v"]) == []
    with pytest.raises(ValueError):
        update_parts(spark, base, spark.createDataFrame([(7, "a"), (7, "b")], "id long, v string"), ["v"])
    assert part_versions(spark, base) == after      # a refused update leaves the table as it was


def test_empty_table_in_parts(spark, tmp_path):
    base = str(tmp_path / "t")
    save_parts(spark.createDataFrame([], "k string, v int"), base, "k")
    assert read_parts(spark, base).count() == 0 and read_parts(spark, base).columns == ["k", "v"]
    assert update_parts(spark, base, spark.createDataFrame([("a", 1)], "k string, v int"), ["v"]) == []


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"create database {name} location '{tmp_path}/db'")
    yield name
    spark.sql(f"drop database {name} cascade")


def test_catalog_targets(spark, database):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    create_tables({"a": a}, database)
    with pytest.raises(ValueError):
        create_tables({"b": a, "a": a}, database)
    assert not spark.catalog.tableExists(f"{database}.b")           # nothing is written when a target exists
    assert ensure_crosswalk(spark, database).columns == ["rec_id", "id_zoho"]
    spark.createDataFrame([("1", "z")], "rec_id string, id_zoho string").write.insertInto(f"{database}.table_firms_zoho")
    assert ensure_crosswalk(spark, database).count() == 1           # an existing one is kept
    swap_table(spark.table(f"{database}.a").withColumn("x", F.col("x") * 10), database, "a")
    swap_table(spark.table(f"{database}.a").where("x > 10"), database, "a")
    assert rows(spark.table(f"{database}.a")) == [(20,)]
    with pytest.raises(Exception):
        swap_table(a.select(F.raise_error(F.lit("broken")).cast("int").alias("x")), database, "a")
    assert rows(spark.table(f"{database}.a")) == [(20,)]            # a failed write leaves the old table
    spark.sql(f"alter table {database}.a rename to {database}.a_old")   # a swap that broke off
    swap_table(a, database, "a")
    assert rows(spark.table(f"{database}.a")) == [(1,), (2,)]
    assert not spark.catalog.tableExists(f"{database}.a_old")


def test_empty_tables_go_only_when_asked(spark, database):
    create_tables({"full": spark.createDataFrame([(1, None)], "x int, y string"), "none": spark.createDataFrame([], "x int")}, database)
    assert profile_database(spark, database) == ["none"]
    assert spark.catalog.tableExists(f"{database}.none")
    assert profile_database(spark, database, drop_empty=True) == ["none"]
    assert not spark.catalog.tableExists(f"{database}.none")
    got = stored_profile(spark, database).select("table_name", "column_name", "total_rows", "distinct_values", "list_distinct_values")
    assert rows(got) == rows(spark.createDataFrame([("full", "x", 1, 1, "1"), ("full", "y", 1, 0, "<null>")],
                                                   "a string, b string, c long, d long, e string"))


def test_merged_sketches_equal_one_pass(spark):
    df = spark.range(20000).selectExpr("id", "id % 700 as few", "cast(null as string) as none", "if(id % 2 = 0, -0.0D, 0.0D) as zero")
    merged = merge_sketches(profile_sketches(df.where("id < 9000"), "t").unionByName(profile_sketches(df.where("id >= 9000"), "t")))
    assert rows(merged) == rows(merge_sketches(profile_sketches(df, "t")))
    exact = {r["column_name"]: r for r in profile_table(df, "t").collect()}
    for r in merged.collect():
        want = exact[r["column_name"]]
        assert (r["total_rows"], r["non_null"]) == (want["total_rows"], want["non_null"])
        assert abs(r["distinct_values"] - want["distinct_values"]) <= 0.03 * want["distinct_values"]
