"""Tables that cut a job's lineage, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: The files of a shuffle are dropped once its query is done; Spark has it as a setting of the session.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; where that is unset, a folder in the session's warehouse, which
    driver and executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_assaylake"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet to ``path`` and read from there. What its query shuffled is dropped, as nothing
    after it goes back there."""
    spark = df.sparkSession
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out


def saved(df: DataFrame, *done: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: the same rows for every later use, also after
    an executor is lost. ``done`` are earlier results of this function that nothing reads any more: they are deleted."""
    out = written(df, f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}")
    for old in done:
        discard(old)
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a result of ``saved``; of any other DataFrame nothing."""
    path = getattr(df, "_table", None)
    if path:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def partitions(rows: int, each: int, spark: SparkSession) -> int:
    """How many partitions hold ``each`` rows or fewer, and one for each core or more."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))
