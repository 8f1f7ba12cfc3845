"""Plate, well and image tables: lifting a coarser level to a finer one, and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of each level.
KEYS = {"plate": ["plate"], "well": ["plate", "well"], "image": ["plate", "well", "image"]}


def level_of(table: DataFrame) -> str:
    return "image" if "image" in table.columns else "well" if "well" in table.columns else "plate"


def lift(table: DataFrame, finer: DataFrame) -> DataFrame:
    """The rows of ``finer`` (keys only) with the columns of the coarser ``table``: an equi-join on the coarser key."""
    return finer.join(table, KEYS[level_of(table)])


def missing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``wanted`` without a row in ``present``."""
    return wanted.select(*keys).distinct().join(present, keys, "left_anti")


def to_image_table(table: DataFrame, images: DataFrame) -> DataFrame:
    """Any level's table with one row for each image; an image without one stops the job with an error."""
    out = images.select(*KEYS["image"]).distinct().join(table.withColumn("_there", F.lit(True)), KEYS[level_of(table)], "left")
    return out.withColumn("_ok", F.assert_true(F.col("_there").isNotNull(), "an image has no row in the table")).where("_ok is null").drop("_ok", "_there")


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are in one table only, with the side that lacks them; empty if the key sets agree."""
    return missing(a, b, keys).withColumn("missing_in", F.lit("right")).unionByName(missing(b, a, keys).withColumn("missing_in", F.lit("left")))
