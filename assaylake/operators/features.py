"""Per-cell features from pixel tables (image, label_id, channel, y, x, v)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL = ["image", "channel", "label_id"]


def cell_features(pixels: DataFrame) -> DataFrame:
    """sums, means and sizes of each cell: one hash aggregate, combined before the shuffle."""
    return pixels.groupBy(*CELL).agg(F.sum("v").alias("sums"), F.avg("v").alias("means"), F.count("*").alias("sizes"))


def cell_median_mad(pixels: DataFrame) -> DataFrame:
    """Lower median, and lower median of deviations from it."""
    centred = pixels.withColumn("medians", F.expr("percentile_disc(0.5) within group (order by v) over (partition by image, channel, label_id)"))
    return centred.groupBy(*CELL).agg(F.first("medians").alias("medians"), F.expr("percentile_disc(0.5) within group (order by abs(v - medians))").alias("mads"))


def cell_quantiles(pixels: DataFrame, quantiles: list[float]) -> DataFrame:
    """quantile<q> of each cell, interpolated."""
    return pixels.groupBy(*CELL).agg(*[F.percentile("v", q).alias(f"quantile{q}") for q in quantiles])


def cell_topk(pixels: DataFrame, k: int) -> DataFrame:
    """The kth largest pixel of each cell, 0 for a cell of fewer: a rank limit, so no cell is gathered whole."""
    ranked = pixels.withColumn("_r", F.row_number().over(Window.partitionBy(*CELL).orderBy(F.desc("v")))).where(F.col("_r") <= k)
    return ranked.groupBy(*CELL).agg(F.coalesce(F.max(F.when(F.col("_r") == k, F.col("v"))), F.lit(0.0)).alias(f"top{k}"))


def region_props(segments: DataFrame) -> DataFrame:
    """Centroid, half-open bounding box and size of each label; a null row for label 0 of each image."""
    cells = segments.where("label_id <> 0").groupBy("image", "label_id").agg(F.avg("y").alias("anchor_y"), F.avg("x").alias("anchor_x"), F.min("y").alias("bb_min_y"), F.min("x").alias("bb_min_x"), (F.max("y") + 1).alias("bb_max_y"), (F.max("x") + 1).alias("bb_max_x"), F.count("*").alias("size"))
    zero = segments.select("image").distinct().withColumn("label_id", F.lit(0).cast(segments.schema["label_id"].dataType))
    return cells.unionByName(zero, allowMissingColumns=True)


def distinct_labels(segments: DataFrame) -> DataFrame:
    """Labels of each image and their sizes."""
    return segments.groupBy("image", "label_id").agg(F.count("*").alias("size"))


def masked(pixels: DataFrame, nuclei: DataFrame) -> DataFrame:
    """Pixels that lie on no nucleus: label_id as it was, nucleus pixels left out."""
    return pixels.join(nuclei.where("nucleus_id <> 0").select("image", "y", "x"), ["image", "y", "x"], "left_anti")

