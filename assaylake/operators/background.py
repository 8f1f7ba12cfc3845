"""Background levels of plates, wells and images, and their subtraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats

SETS = [["plate", "well", "image"], ["plate", "well"], ["plate"]]
NAMES = {3: "image", 2: "well", 1: "plate"}


def background_levels(pixels: DataFrame, outlier_images: DataFrame) -> DataFrame:
    """level, plate, well, image, channel, median, mad of background pixels (label 0), at all three levels.

    Outlier images count at the image level only. Values are counted before the shuffle, so a plate's group is as
    large as its distinct values, and the medians weigh each value by its count."""
    ground = pixels.where("label_id = 0 and v is not null")
    flagged = ground.join(outlier_images.where("is_outlier = 1").select("image").distinct().withColumn("_out", F.lit(1)), "image", "left")
    counts = flagged.groupBy("plate", "well", "image", "channel", "v", "_out").agg(F.count("*").alias("n"))
    out = None
    for keys in SETS:
        own = (counts if len(keys) == 3 else counts.where("_out is null")).groupBy(*keys, "channel", "v").agg(F.sum("n").alias("n"))
        centred = own.withColumn("median", F.percentile("v", F.lit(0.5), F.col("n")).over(Window.partitionBy(*keys, "channel")))
        level = centred.groupBy(*keys, "channel").agg(F.first("median").alias("median"), F.percentile(F.abs(F.col("v") - F.col("median")), F.lit(0.5), F.col("n")).alias("mad")).withColumn("level", F.lit(NAMES[len(keys)]))
        out = level if out is None else out.unionByName(level, allowMissingColumns=True)
    return out


def background_fraction(segments: DataFrame, outlier_images: DataFrame) -> DataFrame:
    """level, plate, well, image, fraction: background pixels of each image, mean of its kept images for a well, mean of
    its wells for a plate."""
    image = segments.groupBy("plate", "well", "image").agg(F.avg((F.col("label_id") == 0).cast("double")).alias("fraction"))
    kept = image.join(outlier_images.where("is_outlier = 1").select("image"), "image", "left_anti")
    well = kept.groupBy("plate", "well").agg(F.avg("fraction").alias("fraction"))
    plate = well.groupBy("plate").agg(F.avg("fraction").alias("fraction"))
    out = image.withColumn("level", F.lit("image"))
    for name, table in (("well", well), ("plate", plate)):
        out = out.unionByName(table.withColumn("level", F.lit(name)), allowMissingColumns=True)
    return out


def from_wells(pixels: DataFrame, wells: DataFrame) -> DataFrame:
    """median and mad over all pixels of the listed (plate, well) rows, per plate and channel; a listed well without
    pixels stops the job with an error."""
    listed = wells.select("plate", "well").distinct()
    own = pixels.join(listed, ["plate", "well"])
    wanted, found = listed.groupBy("plate").agg(F.count("*").alias("wanted")), own.groupBy("plate").agg(F.countDistinct("well").alias("found"))
    complete = wanted.join(found, "plate", "left").select("plate", F.assert_true(F.coalesce("found", F.lit(0)) == F.col("wanted"), "a background well has no pixels").alias("ok"))
    out = stats.mad_of_counts(own, ["plate", "channel"], "v")
    return out.join(complete.where("ok is null").select("plate"), "plate")


def min_well(wells: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """plate, channel, min_well, median, mad: the well with the least background median among those with a background
    fraction in [low, high], ties to the least name. A plate without such a well has no row: ``levels.missing`` finds it."""
    fit = wells.where(F.col("fraction").between(low, high) & F.col("median").isNotNull())
    best = F.min_by(F.struct("well", "median", "mad"), F.struct("median", "well"))
    return fit.groupBy("plate", "channel").agg(best.alias("b")).select("plate", "channel", F.col("b.well").alias("min_well"), "b.median", "b.mad")


def subtract_from_stat(stat: Column, value: Column, background: Column, size: Column) -> Column:
    """A statistic less its background: levels by it, sums by it times the size, spreads, sizes and background columns
    as they are; an unknown statistic stops the job."""
    level = stat.rlike(r"^(means|medians|top|quantile)")
    return F.when(stat.contains("_bg_") | stat.rlike(r"^(mads|sizes)"), value).when(stat == "sums", value - background * size).when(level, value - background).otherwise(F.raise_error(F.concat(F.lit("no rule for statistic "), stat)).cast("double"))


def subtract_from_pixels(pixels: DataFrame, background: DataFrame) -> DataFrame:
    """v less the background of the pixel's image and channel."""
    return pixels.join(background.select("image", "channel", F.col("median").alias("_bg")), ["image", "channel"]).withColumn("v", F.col("v") - F.col("_bg")).drop("_bg")
