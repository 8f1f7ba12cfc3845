"""The whole analysis of plates: cells to background, classes, quality control, and scores of images and wells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import classify, qc, scores


@dataclass
class Settings:
    threshold: float = 4.8
    smallest_cell: float = 250
    largest_cell: float = 12_500
    fewest_cells: int = 10
    most_cells: int = 1000
    min_control: int = 100
    value: str = "means"


def marker_background(cells: DataFrame) -> DataFrame:
    """plate, median, mad of the marker on the background label."""
    return stats.mad_of_counts(cells.where("label_id = 0"), ["plate"], "marker")


def classified_cells(cells: DataFrame, s: Settings) -> DataFrame:
    """Cells (plate, well, image, label_id, sizes, sums, means, marker) with classes and is_outlier; outlier cells are in
    neither class."""
    own = classify.classify(cells, marker_background(cells), ["plate"], threshold=s.threshold)
    bad = qc.size_type(F.col("sizes"), s.smallest_cell, s.largest_cell) != "none"
    own = own.withColumn("is_outlier", bad.cast("int"))
    return own.withColumns({c: F.when(bad, 0).otherwise(F.col(c)) for c in ("is_infected", "is_control")})


def analyse(cells: DataFrame, tags: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(image table, well table)."""
    own = classified_cells(cells, s)
    flags = qc.image_outliers(cells, tags, s.fewest_cells, s.most_cells)
    return scores.image_table(own, flags, s.value), scores.well_table(own, flags, s.value)
