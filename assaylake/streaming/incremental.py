"""Incremental runs: what is still to do, a log of states, and streams that process new files once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.sinks import latest


def todo(inputs: DataFrame, outputs: DataFrame, failed: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Inputs without an output, and those that failed before; all of them with ``force``."""
    if force:
        return inputs.select(key).distinct()
    fresh = inputs.select(key).join(outputs.select(key), key, "left_anti")
    again = inputs.select(key).join(failed.select(key), key, "left_semi")
    return fresh.union(again).distinct()


def validated(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``rows`` with problems: the names of the checks that do not hold (null counts as not)."""
    return rows.withColumn("problems", F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), n) for n, c in checks.items()])))


def must_hold(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``rows``, or an error that names the first row's problems."""
    bad = F.size("problems") > 0
    return validated(rows, checks).withColumn("_e", F.when(bad, F.raise_error(F.concat_ws(",", "problems"))).cast("string")).where("_e is null").drop("_e", "problems")


def states(log: DataFrame) -> DataFrame:
    """The latest state of each (plate, job) of a log (plate, job, state, at)."""
    return latest(log, ["plate", "job"], ["at", "state"])


def unprocessed(jobs: DataFrame, log: DataFrame) -> DataFrame:
    """Jobs (plate, job) whose latest state is not processed."""
    return jobs.join(states(log).where("state = 'processed'"), ["plate", "job"], "left_anti")


def stamped(df: DataFrame, version: str) -> DataFrame:
    return df.withColumn("version", F.lit(version))


def process_new_files(spark: SparkSession, folder: str, schema: StructType, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Every file of the folder that no earlier run has seen goes through ``work`` once; the checkpoint remembers."""
    stream = spark.readStream.schema(schema).parquet(folder)
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
