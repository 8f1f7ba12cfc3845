"""The search for the parameters of cell classification, over all of their axes at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import mad_of_counts
from . import evaluate, pixels
from .classify import grid_counts
from .grids import Grid, opened

#: Pixels of a cell or image, and what they are grouped by.
PIXEL = ["image", "y", "x"]


def infected_cell_grid(
    marker: DataFrame,
    segmentations: dict[str, Callable[[], DataFrame]],
    nuclei: DataFrame,
    truth: DataFrame,
    ignore_nuclei: Sequence[bool] = (True, False),
    denoise_radius: Sequence[int] = (0, 5, 10, 20, 40),
    quantiles: Sequence[float] = (0.9, 0.93, 0.95, 0.96, 0.97, 0.98, 0.99, 0.995),
    thresholds: Sequence[float] = tuple(k / 10 for k in range(100)),
) -> Grid:
    """A grid with the steps denoised, labels, pixels_of_cells, background, statistics, confusion and scores.

    ``marker`` has rows (image, y, x, v), each segmentation and ``nuclei`` rows (image, y, x, label_id), ``truth`` rows
    (image, label_id, truth_control). An opening is computed once for each radius and a segmentation once; the pixels of cells
    meet in one join for all of their combinations, all quantiles of a cell come from one buffer, and all thresholds from
    counts of cells by the number of thresholds that they are over.

    A cell is a control cell if its quantile is not over threshold * MAD + median of the image's background pixels. Cells
    are scored that the segmentation and the truth both have. The f_score of an image is 0 where it is not defined.
    """
    grid = Grid(segmentation=list(segmentations), ignore_nuclei=ignore_nuclei, denoise_radius=denoise_radius, quantile=quantiles, threshold=[float(t) for t in thresholds])

    @grid.step
    def denoised(denoise_radius: int) -> DataFrame:
        rows = marker.select(*PIXEL, "v")
        return pixels.gray_opening(rows, denoise_radius) if denoise_radius else rows

    @grid.step
    def labels(segmentation: str) -> DataFrame:
        return segmentations[segmentation]().select(*PIXEL, "label_id")

    @grid.step(rows=("ignore_nuclei",))
    def pixels_of_cells(labels: DataFrame, denoised: DataFrame, ignore_nuclei: list[bool], by: list[str]) -> DataFrame:
        inside = nuclei.where("label_id <> 0").select(*PIXEL, F.lit(True).alias("_nucleus"))
        rows = labels.join(inside, PIXEL, "left").join(denoised, PIXEL)
        return opened(rows, "ignore_nuclei", ignore_nuclei).where(~F.col("ignore_nuclei") | F.col("_nucleus").isNull() | (F.col("label_id") == 0)).select(*by, "ignore_nuclei", "image", "label_id", "v")

    @grid.step
    def background(pixels_of_cells: DataFrame, by: list[str]) -> DataFrame:
        return mad_of_counts(pixels_of_cells.where("label_id = 0"), [*by, "image"], "v")

    @grid.step(rows=("quantile",))
    def statistics(pixels_of_cells: DataFrame, quantile: list[float], by: list[str]) -> DataFrame:
        own = pixels_of_cells.where("label_id <> 0").groupBy(*by, "image", "label_id").agg(F.percentile("v", quantile).alias("_q"))
        told = F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in quantile]).alias("quantile"), F.col("_q").alias("marker")))
        return own.withColumn("_s", told).select(*by, "image", "label_id", F.col("_s.quantile").alias("quantile"), F.col("_s.marker").alias("marker"))

    @grid.step(rows=("threshold",))
    def confusion(statistics: DataFrame, background: DataFrame, threshold: list[float], by: list[str]) -> DataFrame:
        keys = [a for a in by if a != "quantile"]
        judged = statistics.join(truth.select("image", "label_id", "truth_control"), ["image", "label_id"])
        counts = grid_counts(judged, background, [*keys, "image"], threshold, ["quantile", "truth_control"])
        return evaluate.confusion_of_counts(counts, [*by, "threshold", "image"])

    @grid.step
    def scores(confusion: DataFrame, by: list[str]) -> DataFrame:
        return confusion.groupBy(*by).agg(F.count("*").alias("n_images"), F.avg(F.coalesce("f_score", F.lit(0.0))).alias("f_score"))

    return grid
