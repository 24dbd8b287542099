"""Snapshot publish.

The reference loads ``x_new`` and renames tables by hand. Here a table lives
under ``base/`` as immutable versions ``base/version=<v>/`` plus a one-line
pointer file ``base/_CURRENT``. Readers resolve the pointer; a refresh writes a
complete new version first and flips the pointer last, so a failed write never
leaves readers with an empty or half-written table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def set_current(spark: SparkSession, base: str, version: str) -> None:
    """Make a version of the table at ``base`` that is fully written the current one."""
    jvm = spark.sparkContext._jvm
    fs, _ = _fs(spark, base)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}.tmp")
    final = jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}")
    out = fs.create(tmp, True)
    out.write(bytearray(version.encode("utf-8")))
    out.close()
    # one rename over the old pointer: readers see the old version or the new one
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(tmp), fs.makeQualified(final), options)


def current_version(spark: SparkSession, base: str) -> str | None:
    fs, _ = _fs(spark, base)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def publish(df: DataFrame, base: str, version: str | None = None,
            fmt: str = "parquet", replace: bool = False) -> str:
    """Write ``df`` as a new version of the table at ``base`` and make it
    current. Returns the version name. An existing version is never
    overwritten (``errorifexists``) unless ``replace`` is set, which is meant
    for a version whose writing broke off."""
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    df.write.mode("overwrite" if replace else "errorifexists").format(fmt).save(f"{base}/version={version}")
    set_current(df.sparkSession, base, version)
    return version


def read_current(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a published table."""
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"nothing published under {base}")
    return spark.read.format(fmt).load(f"{base}/version={version}")
