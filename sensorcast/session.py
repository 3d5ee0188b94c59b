"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every sensorcast job relies on.  Event times are naive timestamps
# (``timestamp_ntz``); pinning the session zone keeps any zoned conversion
# deterministic.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # only effective in local mode, where the driver JVM runs the tasks
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "sensorcast",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced.
    Only when it is unset (local tests) a folder is made here.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sensorcast-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written tables."""
    return f"{checkpoint_root(spark)}/sensorcast/{name}-{uuid.uuid4().hex}"


def write_and_read(df, name: str):
    """Materialise a frame as Parquet under the shared checkpoint folder and
    read it back: the lineage starts at the written table, which survives
    executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


__all__ = ["get_session", "checkpoint_root", "scratch_path", "write_and_read", "DEFAULT_CONF"]
