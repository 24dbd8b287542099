"""Tables of the session catalog as targets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote_identifier
from ..operators.profile import PROFILE_COLUMNS, catalog_tables, profile_tables
from ..operators.state import CROSSWALK_SCHEMA

PROFILE_TABLE = "table_column_stats"


def _name(database: str, table: str) -> str:
    return f"{quote_identifier(database)}.{quote_identifier(table)}"


def create_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """Create a table per DataFrame; an existing one is an error (S11) and nothing is written then."""
    taken = [n for n, df in tables.items() if df.sparkSession.catalog.tableExists(_name(database, n))]
    if taken:
        raise ValueError(f"tables exist already: {', '.join(sorted(taken))}")
    for name, df in tables.items():
        df.write.mode("errorifexists").saveAsTable(_name(database, name))


def ensure_crosswalk(spark: SparkSession, database: str, table: str = "table_firms_zoho") -> DataFrame:
    """The crosswalk table, created empty if it is missing."""
    name = _name(database, table)
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], CROSSWALK_SCHEMA).write.saveAsTable(name)
    return spark.table(name)


def swap_table(df: DataFrame, database: str, table: str) -> None:
    """Replace a table by renaming (S19, D4): the new rows are written completely as ``<table>_new``, then the old
    table becomes ``<table>_old`` and the new one takes its name. A failed write leaves the old table in place; a
    swap that broke off between the renames is finished by the next call. ``df`` may read the table itself."""
    spark = df.sparkSession
    new, old, name = (_name(database, t) for t in (f"{table}_new", f"{table}_old", table))
    exists = spark.catalog.tableExists
    if not exists(name) and exists(old):          # broke off after the first rename
        spark.sql(f"alter table {old} rename to {name}")
    for left in (new, old):
        spark.sql(f"drop table if exists {left}")
    df.write.mode("errorifexists").saveAsTable(new)
    if exists(name):
        spark.sql(f"alter table {name} rename to {old}")
    spark.sql(f"alter table {new} rename to {name}")
    spark.sql(f"drop table if exists {old}")


def profile_database(spark: SparkSession, database: str, drop_empty: bool = False,
                     table: str = PROFILE_TABLE) -> list[str]:
    """Profile all base tables of a database and store the result there as a table.

    Returns the names of the tables without rows. They are dropped only with ``drop_empty`` (D5), as the
    reference does; the crosswalk and the profile itself are never dropped or profiled.
    """
    tables = {n: df for n, df in catalog_tables(spark, database).items() if n != table}
    empty = sorted(n for n, df in tables.items() if df.isEmpty())
    if drop_empty:
        for name in empty:
            spark.sql(f"drop table {_name(database, name)}")
    full = {n: df for n, df in tables.items() if n not in empty}
    if full:
        swap_table(profile_tables(full, exclude=(table,)).select(*PROFILE_COLUMNS), database, table)
    return empty


def stored_profile(spark: SparkSession, database: str, table: str = PROFILE_TABLE) -> DataFrame:
    """The stored profile, lists as text."""
    return spark.table(_name(database, table)).withColumn(
        "list_distinct_values", F.array_join("list_distinct_values", "|", "<null>"))
