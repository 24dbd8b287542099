"""Relational stores over JDBC.

The reference copies tables with a bulk loader (batches of rows, parallel
connections) and inserts pages of 1000 rows. Spark's JDBC source does both:
partitioned reads (``partitionColumn`` + bounds, one connection per
partition) and batched, parallel writes. These helpers only set options; no
database is started or tested here (see README).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

INSERT_PAGE_ROWS = 1000  # reference value: insert page size


def read_table(spark: SparkSession, url: str, table: str,
               properties: Mapping[str, str] | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None,
               fetchsize: int = 10_000) -> DataFrame:
    """Remote table scan (S13). With ``partition_column`` and bounds the read
    is split into ``num_partitions`` range queries run in parallel."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetchsize))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned read needs lower, upper and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str,
                properties: Mapping[str, str] | None = None, mode: str = "append",
                batchsize: int = INSERT_PAGE_ROWS, num_partitions: int | None = None,
                truncate: bool = True) -> None:
    """Batched insert (S14) or full replacement (S9, D4). ``mode="overwrite"``
    with ``truncate`` keeps the table definition and empties it; the write is
    then parallel over ``num_partitions`` connections."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url)
              .option("dbtable", table).option("batchsize", batchsize)
              .option("truncate", str(truncate).lower()))
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def copy_table(spark: SparkSession, src_url: str, dst_url: str, table: str,
               src_properties: Mapping[str, str] | None = None,
               dst_properties: Mapping[str, str] | None = None, **read_kw) -> None:
    """Bulk copy one table between stores, replacing the target."""
    df = read_table(spark, src_url, table, src_properties, **read_kw)
    write_table(df, dst_url, table, dst_properties, mode="overwrite")
