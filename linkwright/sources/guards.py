"""Input guards run before anything is written."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every required column that is missing."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in have]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def require_rows(df: DataFrame, what: str = "input") -> None:
    """Raise ``ValueError`` when the frame has no rows (reads one row at most)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")


def require_path(spark: SparkSession, path: str) -> None:
    """Raise ``FileNotFoundError`` unless the path exists on its file system
    (local, HDFS or object store alike, through Hadoop's FileSystem API)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        raise FileNotFoundError(f"input not found: {path}")
