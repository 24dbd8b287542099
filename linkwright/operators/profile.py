"""Column profile of every table in one pass per table.

The reference runs three queries per column plus one per table. Here each
table is read once: its columns are turned into long ``(column, value-as-text)``
rows, grouped by ``(column, value)`` -- hash aggregation combines map-side, so
a value held by a third of all rows costs one row per task -- and the column
statistics come from that small grouped relation. Distinct-value lists are
built only for columns below the limit, so a long list never exists.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.text import quote_identifier

PROFILE_COLUMNS = ["table_name", "column_name", "total_rows", "non_null",
                   "distinct_values", "list_distinct_values", "calculated_at"]
MAX_LIST = 30  # reference value: lists only below 30 distinct values


def _as_text(df: DataFrame, name: str):
    c = F.col(quote_identifier(name))
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        # 0.0 and -0.0 are one value natively but two as text
        c = F.when(c == 0, F.lit(0.0).cast(df.schema[name].dataType)).otherwise(c)
    return c.cast("string")


def profile_table(df: DataFrame, table_name: str, max_list: int = MAX_LIST) -> DataFrame:
    """Profile rows for one table (A1-A4): per column total rows, non-NULL
    count, exact distinct count (NULL not counted) and, when the distinct count
    is below ``max_list``, the distinct values as text with NULL kept as an
    element when the column has NULLs. An empty table yields no rows."""
    cols = df.columns
    if not cols:
        return df.sparkSession.createDataFrame([], profile_schema())
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _as_text(df, c).alias("v")) for c in cols])))
    grouped = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    stats = grouped.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        F.count("v").alias("distinct_values"))
    # Every consumer below reads ``n`` so that all three uses of ``grouped``
    # stay the same plan: Spark then reuses its shuffle, and the table is
    # scanned once (ReusedExchange in the plan).
    present = F.col("n") > 0
    short = (stats.where((F.col("distinct_values") < max_list) & (F.col("total_rows") > 0))
             .select("column_name"))
    # at most one row per column: bounded by the schema, safe to broadcast
    lists = (grouped.join(F.broadcast(short), "column_name")
             .groupBy("column_name")
             .agg(F.collect_list(F.when(present, F.col("v"))).alias("_vals"),
                  F.max(present & F.col("v").isNull()).alias("_has_null")))
    lists = lists.select("column_name", F.when(
        F.col("_has_null"), F.concat(F.array_sort("_vals"), F.array(F.lit(None).cast("string"))))
        .otherwise(F.array_sort("_vals")).alias("list_distinct_values"))
    return (stats.join(lists, "column_name", "left")
            .select(F.lit(table_name).alias("table_name"), "column_name",
                    F.col("total_rows").cast("long"), F.col("non_null").cast("long"),
                    F.col("distinct_values").cast("long"), "list_distinct_values",
                    F.current_timestamp().alias("calculated_at")))


def profile_schema():
    from pyspark.sql.types import (ArrayType, LongType, StringType, StructField,
                                   StructType, TimestampType)
    return StructType([
        StructField("table_name", StringType()), StructField("column_name", StringType()),
        StructField("total_rows", LongType()), StructField("non_null", LongType()),
        StructField("distinct_values", LongType()),
        StructField("list_distinct_values", ArrayType(StringType())),
        StructField("calculated_at", TimestampType())])


def profile_tables(tables: Mapping[str, DataFrame], max_list: int = MAX_LIST,
                   exclude: tuple[str, ...] = ("table_column_stats",)) -> DataFrame:
    """Profile of all tables (M9), unioned. The profile's own output table is
    skipped. Empty tables contribute no rows (see ``empty_tables``)."""
    parts = [profile_table(df, name, max_list) for name, df in tables.items()
             if name not in exclude]
    if not parts:
        raise ValueError("no tables to profile")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def catalog_tables(spark, database: str) -> dict:
    """Base tables of a catalog database as ``{name: DataFrame}`` (P13):
    managed and external tables only, no views or temporary tables."""
    return {t.name: spark.table(f"{database}.{t.name}")
            for t in spark.catalog.listTables(database)
            if not t.isTemporary and (t.tableType or "").upper() in ("MANAGED", "EXTERNAL")}


def empty_tables(tables: Mapping[str, DataFrame]) -> list[str]:
    """Names of tables without rows (D5). The reference drops them while
    profiling; here the caller decides (nothing is dropped by default)."""
    return [name for name, df in tables.items() if df.isEmpty()]


#: Size of a distinct-count sketch (2^LG_K registers): a standard error of 0.8 percent.
LG_K = 14


def profile_sketches(df: DataFrame, table_name: str) -> DataFrame:
    """Mergeable profile of one version of a table (A3, A5): ``(table_name, column_name, total_rows, non_null, sketch)``.

    One aggregate over one scan; a task sends one sketch per column, whatever its rows, so no value is
    shuffled. Store the rows per version: a new version is profiled alone, and ``merge_sketches`` of all stored
    rows equals one pass over all versions. ``sketch`` is NULL for a column without values.
    """
    cols = df.columns
    sums = df.agg(F.count(F.lit(1)).alias("n"), *[
        x for i, c in enumerate(cols)
        for x in (F.count(quote_identifier(c)).alias(f"c{i}"), F.hll_sketch_agg(_as_text(df, c), LG_K).alias(f"s{i}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("total_rows"), F.col(f"c{i}").alias("non_null"),
                              F.when(F.col(f"c{i}") > 0, F.col(f"s{i}")).alias("sketch")) for i, c in enumerate(cols)])
    return sums.select(F.lit(table_name).alias("table_name"), F.inline(rows))


def merge_sketches(stored: DataFrame) -> DataFrame:
    """Profile rows of stored versions as one: ``(table_name, column_name, total_rows, non_null, distinct_values)``,
    the distinct count estimated from the united sketches."""
    return (stored.groupBy("table_name", "column_name")
            .agg(F.sum("total_rows").alias("total_rows"), F.sum("non_null").alias("non_null"),
                 F.hll_union_agg("sketch").alias("sketch"))
            .select("table_name", "column_name", "total_rows", "non_null",
                    F.when(F.col("non_null") > 0, F.hll_sketch_estimate("sketch")).otherwise(0).alias("distinct_values")))
