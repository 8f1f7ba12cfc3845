"""Infected and control cells by a robust threshold on the marker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_over(x: Column, threshold: Column | float, scale: Column, offset: Column) -> Column:
    return x > scale * threshold + offset


def classify(cells: DataFrame, background: DataFrame, keys: list[str], stat: str = "marker", threshold: float = 4.8) -> DataFrame:
    """``cells`` with is_infected and is_control (1/0): over ``threshold`` MADs above the background's median, or not;
    label 0 is neither."""
    own = cells.join(background.select(*keys, F.col("median").alias("_off"), F.col("mad").alias("_scale")), keys)
    over, cell = is_over(F.col(stat), threshold, F.col("_scale"), F.col("_off")), F.col("label_id") != 0
    return own.withColumn("is_infected", (cell & over).cast("int")).withColumn("is_control", (cell & ~over).cast("int")).drop("_off", "_scale")


def classify_grid(cells: DataFrame, background: DataFrame, keys: list[str], thresholds: list[float], stat: str = "marker") -> DataFrame:
    """The same for each threshold, in rows: a cell's thresholds are one array, opened beside it, so nothing is shuffled."""
    opened = cells.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    own = opened.join(background.select(*keys, F.col("median").alias("_off"), F.col("mad").alias("_scale")), keys)
    over, cell = is_over(F.col(stat), F.col("threshold"), F.col("_scale"), F.col("_off")), F.col("label_id") != 0
    return own.withColumn("is_infected", (cell & over).cast("int")).withColumn("is_control", (cell & ~over).cast("int")).drop("_off", "_scale")


def grid_counts(cells: DataFrame, background: DataFrame, keys: list[str], thresholds: list[float], by: list[str], stat: str = "marker") -> DataFrame:
    """keys, by, threshold, is_control, n: how many cells other than label 0 each threshold calls control or not.

    A cell is over the first so many of the thresholds, in order, as the scale is not negative. So cells are counted by that
    number in one pass, and only the counts are told out to all thresholds."""
    ordered = sorted(float(t) for t in thresholds)
    own = cells.where("label_id <> 0").join(background.select(*keys, F.col("median").alias("_off"), F.col("mad").alias("_scale")), keys)
    over = F.size(F.filter(F.array(*[F.lit(t) for t in ordered]), lambda t: is_over(F.col(stat), t, F.col("_scale"), F.col("_off"))))
    counts = own.groupBy(*keys, *by, over.alias("_over")).agg(F.count("*").alias("n"))
    told = counts.select("*", F.posexplode(F.array(*[F.lit(t) for t in ordered])).alias("_k", "threshold"))
    control = (F.col("_over") <= F.col("_k")).cast("int").alias("is_control")
    return told.groupBy(*keys, *by, "threshold", control).agg(F.sum("n").alias("n"))


def without_outliers(classified: DataFrame, outliers: DataFrame) -> DataFrame:
    """Outlier cells are in neither group; cells without an outlier row count as fine."""
    flags = outliers.select("image", "label_id", F.col("is_outlier").alias("_o"))
    bad = F.coalesce(F.col("_o"), F.lit(0)) == 1
    out = classified.join(flags, ["image", "label_id"], "left")
    return out.withColumns({c: F.when(bad, 0).otherwise(F.col(c)) for c in ("is_infected", "is_control")}).drop("_o")
