"""Tables in parts: a key update rewrites only the parts it touches.

A table lives under ``base/`` in a fixed number of parts by key hash. Each part is a folder
``version=<v>/_part=<p>``; the pointer ``base/_CURRENT`` names for every part the version that holds it. An
update reads the parts of its keys, writes them as a new version and moves the pointer last, in one rename: readers see
the table before or after it, never between. Untouched parts are neither read nor written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import update_by_key
from .publish import current_version, set_current

PARTS = 64
_PART = "_part"


def _part_of(key, kind: str, parts: int):
    """A key's part; NULL keys share one, which no update touches on their account."""
    return F.pmod(F.xxhash64(key.cast(kind)), F.lit(parts)).cast("int")


def _manifest(spark: SparkSession, base: str) -> dict:
    line = current_version(spark, base)
    if line is None:
        raise FileNotFoundError(f"no table in parts under {base}")
    return json.loads(line)


def _write(df: DataFrame, base: str, parts: int) -> tuple[str, list[int]]:
    """Write rows with ``_part`` as a new version: its name and the parts it holds."""
    version = uuid.uuid4().hex
    path = f"{base}/version={version}"
    df.repartition(parts, _PART).write.partitionBy(_PART).parquet(path)
    held = df.sparkSession.read.parquet(path).select(_PART).distinct().collect()   # at most one row per part
    return version, sorted(r[_PART] for r in held)


def save_parts(df: DataFrame, base: str, key: str, parts: int = PARTS) -> None:
    """Write a table in parts by ``key``; what ``base`` held before is replaced when the new parts are complete."""
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    version, held = _write(df.withColumn(_PART, _part_of(F.col(key), kind, parts)), base, parts) if not df.isEmpty() else ("", [])
    set_current(spark, base, json.dumps({"key": key, "parts": parts, "schema": json.loads(df.schema.json()),
                                         "versions": {str(p): version for p in held}}))


def part_versions(spark: SparkSession, base: str) -> dict[int, str]:
    """The version that holds each part that has rows."""
    return {int(p): v for p, v in _manifest(spark, base)["versions"].items()}


def _read(spark: SparkSession, base: str, manifest: dict, only: Sequence[int] | None = None) -> DataFrame:
    from pyspark.sql.types import StructType
    schema = StructType.fromJson(manifest["schema"])
    paths = [f"{base}/version={v}/{_PART}={p}" for p, v in manifest["versions"].items() if only is None or int(p) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_parts(spark: SparkSession, base: str) -> DataFrame:
    """The table as it is now, one scan."""
    return _read(spark, base, _manifest(spark, base))


def update_parts(spark: SparkSession, base: str, updates: DataFrame, columns: Sequence[str],
                 dedupe_order: Sequence[tuple[str, bool]] | None = None) -> list[int]:
    """``update_by_key`` on a table in parts; returns the parts rewritten.

    Parts that no update key falls into stay as they are, as do those a key falls into that have no rows. Update keys
    are unique or ``dedupe_order`` picks one; NULL keys and keys the table does not have change nothing.
    """
    manifest = _manifest(spark, base)
    key, parts = manifest["key"], manifest["parts"]
    kind = next(f["type"] for f in manifest["schema"]["fields"] if f["name"] == key)
    kind = {"long": "bigint", "integer": "int"}.get(kind, kind)
    keys = updates.where(F.col(key).isNotNull()).select(_part_of(F.col(key), kind, parts).alias(_PART)).distinct()
    touched = sorted({r[_PART] for r in keys.collect()} & {int(p) for p in manifest["versions"]})   # at most one row per part
    if not touched:
        return []
    target = _read(spark, base, manifest, touched)
    updated = update_by_key(target, updates, key, columns, dedupe_order=dedupe_order)
    version, held = _write(updated.withColumn(_PART, _part_of(F.col(key), kind, parts)), base, parts)
    manifest["versions"].update({str(p): version for p in held})
    set_current(spark, base, json.dumps(manifest))
    return touched
