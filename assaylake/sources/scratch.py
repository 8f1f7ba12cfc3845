"""Folders for intermediate tables, which the driver and all executors must share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, a session whose tasks are threads of this machine
    gets a temporary folder; on a cluster it is an error, as executors don't see each other's disks."""
    base = spark.conf.get(SETTING, None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that all executors share: the tasks of {master} run on several machines")
        base = tempfile.gettempdir() + "/assaylake"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and all that is in it; nothing happens where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
