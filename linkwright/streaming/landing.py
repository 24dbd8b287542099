"""Incremental key updates from a CSV landing folder.

The reference applies one CSV of updates per run. As a Structured Streaming
job the same update runs for every new file in a landing folder: the file
source tracks which files were processed in the query's checkpoint, and
``trigger(availableNow=True)`` processes what has landed and stops, so a
scheduler can run it like a batch job with exactly-once bookkeeping.

Each micro-batch reads the current version of the published target, applies
the key update and publishes the result as version ``epoch-<id>``. A retried
epoch finds its version completely written (``_SUCCESS``) and only re-points the
table; a version whose writing broke off is written again. So the sink is
idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.refresh import update_from_text
from ..sources.csv import CSV_OPTIONS
from ..sources.publish import _fs, publish, read_current, set_current


def _version_complete(spark: SparkSession, base: str, version: str) -> bool:
    fs, _ = _fs(spark, base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/version={version}/_SUCCESS")
    return fs.exists(path)


def apply_landing_updates(spark: SparkSession, landing: str, target_base: str, key: str,
                          columns: Sequence[str], checkpoint: str):
    """Start an ``availableNow`` stream that applies every new CSV in
    ``landing`` to the table published at ``target_base``. Returns the
    ``StreamingQuery``; call ``awaitTermination()`` to wait for the catch-up.

    ``checkpoint`` must be a shared folder (it records processed files).
    """
    schema = StructType([StructField(c, StringType(), True) for c in [key, *columns]])
    stream = (spark.readStream.options(**CSV_OPTIONS).schema(schema)
              .option("pathGlobFilter", "*.csv").csv(landing))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        version = f"epoch-{epoch_id:010d}"
        if _version_complete(spark, target_base, version):
            set_current(spark, target_base, version)   # retried epoch
            return
        if batch.isEmpty():
            return
        current = read_current(spark, target_base)
        updated = update_from_text(current, batch, key, list(columns), flag=None)
        publish(updated, target_base, version, replace=True)

    return (stream.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
