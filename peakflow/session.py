"""Session and shared-folder helpers for tests, the bench and command-line use.

Operators never create or configure a session; only these helpers do.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "peakflow", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used by the operators)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (cores if cores != "*" else 8))
    conf["spark.driver.memory"] = os.environ.get("PEAKFLOW_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scratch_base(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where a session leaves that setting out, the folder ``_scratch`` of its SQL
    warehouse is used, which driver and executors share as well. A machine-local
    temporary folder is never used.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (d or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def _app_folder(spark: SparkSession) -> str:
    """This application's own folder under the shared one; its file system deletes it when the JVM ends."""
    folder = f"{scratch_base(spark)}/peakflow-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set the context's checkpoint folder, if nothing has, to this application's shared folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(_app_folder(spark) + "/checkpoints")
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under this application's shared folder, for sinks and materialised stages."""
    return f"{_app_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``shared_path`` named, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
