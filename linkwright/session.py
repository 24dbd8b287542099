"""Session helpers: one place for the settings every job relies on.

On a cluster the session is built by the platform; ``configure`` only fills in
values that are unset so that cluster-wide settings always win.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the library assumes. AQE re-plans joins at run time (broadcast when a
# side turns out small, splits skewed partitions), which matters for the
# candidate joins of the fuzzy matcher where a few keys can be hot.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "linkwright",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Used by tests, the bench and the command-line entry points; library
    functions never create sessions themselves.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that local folders are shared."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared folder (HDFS, object store) there. Only when it
    is unset do we pick a folder ourselves, and only for a local master: on a
    cluster a folder of one machine would be lost to the others, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(os.environ.get("LINKWRIGHT_LOCAL_DIR", "/tmp"),
                                  "linkwright-checkpoints")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether all executors reach ``folder``: any URI but a plain local one, and a local one in local mode or
    under the checkpoint folder or the warehouse, which the cluster shares whatever their scheme."""
    def local(path: str) -> str | None:
        path = path.removeprefix("file:")
        return os.path.normpath("/" + path.lstrip("/")) if path.startswith("/") else None

    at = local(folder)
    if at is None or is_local(spark):
        return True
    shared = [local(p) for p in (ensure_checkpoint_dir(spark), spark.conf.get("spark.sql.warehouse.dir", ""))]
    return any(s is not None and s != "/" and (at + "/").startswith(s + "/") for s in shared)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint dir for intermediate tables."""
    return f"{ensure_checkpoint_dir(spark)}/scratch/{purpose}-{uuid.uuid4().hex}"


def connection_check(spark: SparkSession):
    """One row with the session's clock, engine version and current database
    (F21), the equivalent of the reference's connection test query."""
    return spark.sql("select current_timestamp() as now, version() as version, "
                     "current_database() as database")
