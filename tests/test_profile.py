"""Column profile."""
from pyspark.sql import functions as F

from linkwright.operators.profile import empty_tables, profile_table, profile_tables


def test_profile_semantics(spark):
    data = [(i, str(i % 30), None, 0.0 if i % 2 else -0.0) for i in range(60)]
    df = spark.createDataFrame(data, "a long, b string, z string, f double")
    df = df.withColumn("b29", F.when(F.col("a") < 29, F.col("a").cast("string")))
    prof = {r.column_name: r for r in profile_table(df, "t").collect()}
    assert prof["a"].distinct_values == 60 and prof["a"].list_distinct_values is None
    assert prof["b"].distinct_values == 30 and prof["b"].list_distinct_values is None  # strict
    assert prof["z"].non_null == 0 and prof["z"].distinct_values == 0
    assert prof["z"].list_distinct_values == [None]
    assert prof["f"].distinct_values == 1                      # 0.0 and -0.0 are one value
    assert prof["b29"].distinct_values == 29 and prof["b29"].list_distinct_values[-1] is None
    assert all(r.total_rows == 60 for r in prof.values())


def test_empty_tables_reported_not_dropped(spark):
    e = spark.createDataFrame([], "x string")
    t = spark.createDataFrame([("1",)], "x string")
    assert empty_tables({"e": e, "t": t}) == ["e"]
    assert {r.table_name for r in profile_tables({"e": e, "t": t}).collect()} == {"t"}


def test_profile_has_no_expand(spark):
    """One long-format aggregation, not one count(distinct) per column."""
    df = spark.range(100).selectExpr("id", "cast(id % 7 as string) s", "id * 2 as t")
    plan = profile_table(df, "p")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_profile_scans_each_table_once(spark, tmp_path):
    spark.range(200).selectExpr("id", "cast(id % 7 as string) s").write.parquet(str(tmp_path / "t"))
    df = profile_table(spark.read.parquet(str(tmp_path / "t")), "t")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "ReusedExchange" in final


def test_catalog_tables_lists_base_tables_only(spark, tmp_path):
    """managed/external tables of a database, no views or temporary tables."""
    from linkwright.operators.profile import catalog_tables
    db = "lw_catalog_test"
    spark.sql(f"create database if not exists {db} location '{tmp_path / 'db'}'")
    spark.range(3).write.mode("overwrite").saveAsTable(f"{db}.base_t")
    spark.range(2).createOrReplaceTempView("temp_v")
    tables = catalog_tables(spark, db)
    assert set(tables) == {"base_t"}
    assert tables["base_t"].count() == 3
