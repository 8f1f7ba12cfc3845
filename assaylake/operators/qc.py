"""Quality control of cells, images and wells. Flags: -1 not checked, 0 fine, 1 outlier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .criteria import IMAGE, IMAGE_DEFAULTS, WELL, WELL_DEFAULTS, compiled, judged


def size_type(size: Column, smallest: float, largest: float) -> Column:
    return F.when(size > largest, "too_large").when(size < smallest, "too_small").otherwise("none")


def cell_outliers(cells: DataFrame, smallest: float, largest: float, nuclei: DataFrame | None = None, nucleus_limits: tuple[float, float] | None = None) -> DataFrame:
    """image, label_id, is_outlier, outlier_type of rows (image, label_id, sizes), label 0 included. With nuclei (same
    columns) both parts are checked and the type names them."""
    own = size_type(F.col("sizes"), smallest, largest)
    if nuclei is None:
        return cells.select("image", "label_id", (own != "none").cast("int").alias("is_outlier"), own.alias("outlier_type"))
    inner = nuclei.select("image", "label_id", F.col("sizes").alias("_n"))
    part = F.coalesce(size_type(F.col("_n"), *nucleus_limits), F.lit("none"))
    both = cells.join(inner, ["image", "label_id"], "left")
    return both.select("image", "label_id", ((own != "none") | (part != "none")).cast("int").alias("is_outlier"), F.concat(F.lit("cell:"), own, F.lit(",nucleus:"), part).alias("outlier_type"))


def size_mask(pixels: DataFrame, smallest: int = 100, largest: int = 25_000) -> DataFrame:
    """Pixels of cells (not label 0) that are too small or too large."""
    sizes = pixels.where("label_id <> 0").groupBy("image", "label_id").agg(F.count("*").alias("n"))
    bad = sizes.where((F.col("n") < smallest) | (F.col("n") > largest))
    return pixels.join(bad.select("image", "label_id"), ["image", "label_id"], "left_semi")


def image_outliers(labels: DataFrame, tags: DataFrame, fewest: float | None = IMAGE_DEFAULTS["min_number_cells"], most: float | None = IMAGE_DEFAULTS["max_number_cells"]) -> DataFrame:
    """image, is_outlier, outlier_type: cells are labels less one; a manual tag of 1, or any tag where there is nothing to
    check (both limits None), decides over the count."""
    counted = labels.groupBy("image").agg((F.countDistinct("label_id") - 1).alias("n_cells"))
    flag, why = compiled(IMAGE, {"min_number_cells": fewest, "max_number_cells": most})
    kind = F.when(F.size(why) > 0, F.concat_ws(";", why)).otherwise("none")
    manual = F.coalesce(F.col("tag"), F.lit(-1))
    return counted.join(manual_tags(tags), "image", "left").select("image", F.when((manual == 1) | (flag == -1), manual).otherwise(flag).alias("is_outlier"), F.concat(F.lit("manual: "), manual.cast("string"), F.lit("; heuristic: "), kind).alias("outlier_type"))


def manual_tags(tags: DataFrame) -> DataFrame:
    """image, tag; a tag outside -1, 0, 1 stops the job with an error."""
    return tags.select("image", F.when(F.col("tag").isin(-1, 0, 1), F.col("tag")).otherwise(F.raise_error(F.lit("a manual tag must be -1, 0 or 1")).cast("int")).alias("tag"))


def well_outliers(wells: DataFrame, min_control: float | None = WELL_DEFAULTS["min_number_control_cells"], min_infected: float | None = 0, min_intensity: Column | float | None = None, max_ratio: float | None = None) -> DataFrame:
    """plate, well, is_outlier, outlier_type from n_control, n_infected, infected_mean (null never flags) and, if a limit
    is given, ratio; -1 and not_checked if no limit is."""
    limits = {"min_number_control_cells": min_control, "min_number_infected_cells": min_infected, "min_infected_intensity": min_intensity, "max_ratio": max_ratio}
    return judged(wells, WELL, limits).select("plate", "well", "is_outlier", "outlier_type")


def intensity_floor(background: DataFrame, preset: float, times: float = 3.0) -> DataFrame:
    """plate, channel, floor: ``times`` the MAD of the empty wells, the preset where that is missing."""
    return background.select("plate", "channel", F.coalesce(F.col("mad") * times, F.lit(preset)).alias("floor"))


def with_flags(rows: DataFrame, outliers: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with is_outlier and outlier_type, -1 and not_checked where no row says otherwise."""
    flags = outliers.select(*keys, "is_outlier", "outlier_type")
    return rows.join(flags, keys, "left").withColumn("is_outlier", F.coalesce("is_outlier", F.lit(-1))).withColumn("outlier_type", F.coalesce("outlier_type", F.lit("not_checked")))


def score_unless_outlier(score: Column, is_outlier: Column) -> Column:
    return F.when(F.coalesce(is_outlier, F.lit(0)) == 1, F.lit(None)).otherwise(score)


def outlier_rates(flags: DataFrame) -> DataFrame:
    """plate (null: all), n, outlier_rate, heuristic_rate, manual_rate from rows (plate, is_outlier, outlier_type)."""
    manual = F.col("outlier_type").contains("manual: 1")
    heuristic = (F.col("is_outlier") == 1) & ~manual
    share = lambda c: F.avg(c.cast("double"))
    return flags.rollup("plate").agg(F.count("*").alias("n"), share(F.col("is_outlier") == 1).alias("outlier_rate"), share(heuristic).alias("heuristic_rate"), share(manual).alias("manual_rate"))


def plate_ratings(ratings: DataFrame) -> DataFrame:
    """plate, mean_rating over ratings other than 0 (null without one), n_images."""
    return ratings.groupBy("plate").agg(F.avg(F.when(F.col("rating") != 0, F.col("rating"))).alias("mean_rating"), F.count("*").alias("n_images"))
