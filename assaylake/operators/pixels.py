"""Neighbour operators on dense pixel tables (image, y, x, v). Rows are ordered within an image's row or column only,
so a window is as long as an image is wide or high."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-6


def _along(axis: str) -> Window:
    other = "y" if axis == "x" else "x"
    return Window.partitionBy("image", other).orderBy(axis)


def seg_edges(labels: DataFrame) -> DataFrame:
    """edge: the label differs between the left and right, or the upper and lower neighbour; at the border the pixel
    stands for the missing one."""
    near = lambda f, axis: F.coalesce(f("label_id", 1).over(_along(axis)), F.col("label_id"))
    return labels.withColumn("edge", ((near(F.lag, "x") != near(F.lead, "x")) | (near(F.lag, "y") != near(F.lead, "y"))).cast("int"))


def disk_filter(pixels: DataFrame, radius: int, largest: bool, value: str = "v") -> DataFrame:
    """The least or largest value within a disk: row windows of each half width, then shifted rows of them: two sorts,
    whatever the radius."""
    agg, pick, across = (F.max, F.greatest, "x") if largest else (F.min, F.least, "x")
    half = {dy: math.isqrt(radius * radius - dy * dy) for dy in range(radius + 1)}
    rows = pixels.withColumns({f"_w{k}": agg(value).over(_along(across).rowsBetween(-k, k)) for k in sorted(set(half.values()))})
    down = _along("y")
    parts = [F.col(f"_w{half[0]}")]
    for dy in range(1, radius + 1):
        parts += [F.lag(f"_w{half[dy]}", dy).over(down), F.lead(f"_w{half[dy]}", dy).over(down)]
    out = pick(*parts) if len(parts) > 1 else parts[0]
    return rows.withColumn(value, out).drop(*[f"_w{k}" for k in set(half.values())])


def gray_opening(pixels: DataFrame, radius: int) -> DataFrame:
    return disk_filter(disk_filter(pixels, radius, largest=False), radius, largest=True)


def white_tophat(pixels: DataFrame, radius: int) -> DataFrame:
    """v less its opening; the original travels along, so there is no join."""
    return gray_opening(pixels.withColumn("_v", F.col("v")), radius).withColumn("v", F.col("_v") - F.col("v")).drop("_v")


def erode_labels(labels: DataFrame, radius: int) -> DataFrame:
    """Labels within ``radius`` of an edge become 0."""
    near = disk_filter(seg_edges(labels), radius - 1, largest=True, value="edge")
    return near.withColumn("label_id", F.when(F.col("edge") == 1, 0).otherwise(F.col("label_id"))).drop("edge")


def _cross(mask: DataFrame, largest: bool, border: int) -> DataFrame:
    near = [F.coalesce(f("m", 1).over(_along(axis)), F.lit(border)) for axis in "xy" for f in (F.lag, F.lead)]
    return mask.withColumn("m", (F.greatest if largest else F.least)(F.col("m"), *near))


def open_close(mask: DataFrame, times: int = 2) -> DataFrame:
    """Opening, then closing of a 0/1 mask m with a cross; outside the image is 0."""
    for largest in (False, True, True, False):
        for _ in range(times):
            mask = _cross(mask, largest, 0)
    return mask


def standardize(pixels: DataFrame) -> DataFrame:
    own = Window.partitionBy("image")
    return pixels.withColumn("v", (F.col("v") - F.avg("v").over(own)) / F.greatest(F.stddev_pop("v").over(own), F.lit(EPS)))


def minmax(pixels: DataFrame) -> DataFrame:
    own = Window.partitionBy("image")
    low = F.min("v").over(own)
    return pixels.withColumn("v", (F.col("v") - low) / (F.max("v").over(own) - low + EPS))


def to_uint8(pixels: DataFrame) -> DataFrame:
    return minmax(pixels).withColumn("v", F.floor(F.col("v") * 255).cast("int"))


def percentile_normalize(pixels: DataFrame, low: float = 0.03, high: float = 0.998, clip: bool = False) -> DataFrame:
    """(v - p_low) / (p_high - p_low + eps): percentiles are aggregated first and joined, a row an image."""
    p = pixels.groupBy("image").agg(F.percentile("v", low).alias("_lo"), F.percentile("v", high).alias("_hi"))
    out = (F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + EPS)
    return pixels.join(p, "image").withColumn("v", F.greatest(F.lit(0.0), F.least(F.lit(1.0), out)) if clip else out).drop("_lo", "_hi")


def quantile_normalize(pixels: DataFrame) -> DataFrame:
    """(v - p1) / p99 within [0, 1]: divided by the percentile itself."""
    p = pixels.groupBy("image").agg(F.percentile("v", 0.01).alias("_lo"), F.percentile("v", 0.99).alias("_hi"))
    return pixels.join(p, "image").withColumn("v", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.col("v") - F.col("_lo"), F.col("_hi"))))).drop("_lo", "_hi")


def contrast_limits(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("image").agg(F.percentile("v", 0.01).alias("low"), F.percentile("v", 0.99).alias("high"))


def downscale(pixels: DataFrame, factor: int) -> DataFrame:
    """Block means, incomplete blocks at the far border left out."""
    own = Window.partitionBy("image")
    sized = pixels.withColumn("_h", F.floor((F.max("y").over(own) + 1) / factor)).withColumn("_w", F.floor((F.max("x").over(own) + 1) / factor))
    block = sized.withColumn("y", F.floor(F.col("y") / factor)).withColumn("x", F.floor(F.col("x") / factor)).where("y < _h and x < _w")
    return block.groupBy("image", "y", "x").agg(F.avg("v").alias("v"))


def downscale_labels(labels: DataFrame, factor: int) -> DataFrame:
    """Nearest neighbour: the first pixel of each block."""
    return labels.where((F.col("y") % factor == 0) & (F.col("x") % factor == 0)).withColumn("y", F.floor(F.col("y") / factor)).withColumn("x", F.floor(F.col("x") / factor))


def illumination_correct(pixels: DataFrame, corrector: DataFrame) -> DataFrame:
    """(v - offset) / divisor + offset by pixel; the corrector has one row a pixel of a channel."""
    return pixels.join(corrector, ["channel", "y", "x"]).withColumn("v", F.try_divide(F.col("v") - F.col("offset"), F.col("divisor")) + F.col("offset")).drop("offset", "divisor")


def estimate_corrector(pixels: DataFrame, outliers: DataFrame) -> DataFrame:
    """channel, y, x, n, mean, variance over images that are no outliers, each image divided by its mean."""
    kept = pixels.join(outliers.where("is_outlier = 1").select("image"), "image", "left_anti")
    shares = kept.withColumn("v", F.try_divide(F.col("v"), F.avg("v").over(Window.partitionBy("image", "channel"))))
    return shares.groupBy("channel", "y", "x").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("variance"))


def corrector_moments(pixels: DataFrame, outliers: DataFrame) -> DataFrame:
    """plate, channel, y, x, n, mean, m2 (sum of squared deviations) over a plate's images that are no outliers."""
    kept = pixels.join(outliers.where("is_outlier = 1").select("image"), "image", "left_anti")
    return kept.groupBy("plate", "channel", "y", "x").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"))


def merged_moments(moments: DataFrame) -> DataFrame:
    """Moments of parts of the images put together: the same as those of all images at once. The parts' means are taken
    relative to their own, so nothing cancels; window and aggregate share an exchange."""
    key = ["plate", "channel", "y", "x"]
    own = Window.partitionBy(*key)
    mean = F.try_divide(F.sum(F.col("n") * F.coalesce("mean", F.lit(0.0))).over(own), F.sum("n").over(own))
    off = F.col("mean") - F.col("_mean")
    return moments.withColumn("_mean", mean).groupBy(*key).agg(F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))


def corrector(moments: DataFrame, offset: float = 550.0, sigma: float = 30.0) -> DataFrame:
    """channel, y, x, offset, divisor: the mean over plates of each plate's average image, less the offset and relative to its own
    mean, weighted by the plate's images, then blurred. What ``illumination_correct`` takes."""
    whole = Window.partitionBy("plate", "channel")
    level = F.col("mean") - F.lit(float(offset))
    shares = moments.where("n > 0").select("channel", "y", "x", F.max("n").over(whole).alias("w"), F.try_divide(level, F.avg(level).over(whole)).alias("s"))
    together = shares.groupBy("channel", "y", "x").agg(F.try_divide(F.sum(F.col("w") * F.col("s")), F.sum("w")).alias("v"))
    smooth = blur(together.withColumnRenamed("channel", "image"), sigma) if sigma else together.withColumnRenamed("channel", "image")
    return smooth.select(F.col("image").alias("channel"), "y", "x", F.lit(float(offset)).alias("offset"), F.col("v").alias("divisor"))


def blur(pixels: DataFrame, sigma: float) -> DataFrame:
    """Separable Gaussian blur up to 3 sigma, weights normalised at the border: shifted neighbours of a row, then of a
    column, no pixel is multiplied into rows."""
    reach = math.ceil(3 * sigma)
    for axis in "xy":
        total, weight = F.lit(0.0), F.lit(0.0)
        for d in range(-reach, reach + 1):
            w = math.exp(-d * d / (2 * sigma * sigma))
            near = F.col("v") if d == 0 else F.lag("v", -d).over(_along(axis)) if d < 0 else F.lead("v", d).over(_along(axis))
            total, weight = total + F.coalesce(near * w, F.lit(0.0)), weight + F.when(near.isNotNull(), w).otherwise(0.0)
        pixels = pixels.withColumn("v", total / weight)
    return pixels


def cell_outline(labels: DataFrame, width: int = 1) -> DataFrame:
    """The label where it is within ``width`` steps of another label, else 0; the outside counts as the same label."""
    inner = labels.withColumn("m", F.lit(1))
    for step in range(width):
        same = lambda f, axis: F.coalesce(F.when(f("label_id", 1).over(_along(axis)) == F.col("label_id"), f("m", 1).over(_along(axis))).when(f("label_id", 1).over(_along(axis)).isNotNull(), 0), F.lit(1))
        inner = inner.withColumn("m", F.least("m", *[same(f, axis) for axis in "xy" for f in (F.lag, F.lead)]))
    return inner.withColumn("outline", F.when(F.col("m") == 0, F.col("label_id")).otherwise(0)).drop("m")


def prepare_seeds(pixels: DataFrame, erode: int, dilate: int) -> DataFrame:
    """mask eroded, seed dilated, seeds added to the mask."""
    out = disk_filter(pixels, erode, largest=False, value="mask")
    out = disk_filter(out, dilate, largest=True, value="seed")
    return out.withColumn("mask", F.greatest("mask", (F.col("seed") > 0).cast("int")))


def ring_radius(pixels: DataFrame, factor: float) -> DataFrame:
    """image, radius: ``factor`` times the root of the median size of an image's seeds, cut to a whole number; 0 without seeds."""
    sizes = pixels.groupBy("image", "seed").agg(F.count("*").alias("_n"))
    size = F.median(F.when(F.col("seed") != 0, F.col("_n")))
    return sizes.groupBy("image").agg(F.coalesce(F.floor(F.lit(float(factor)) * F.sqrt(size)), F.lit(0)).cast("long").alias("radius"))


def nearest_seed(pixels: DataFrame, radius: int | DataFrame, drop_nucleus: bool = False) -> DataFrame:
    """label of the nearest seed pixel closer than ``radius`` for each background pixel, ties to the smaller label; seed
    pixels keep theirs, or get 0 with ``drop_nucleus``. The radius is one for all images, or rows (image, radius).

    Only seed pixels with a neighbour that is not of their label can be nearest. They are dealt to the grid cells of the
    image's radius around them, and each background pixel meets those of its own cell."""
    own = pixels.withColumn("_r", F.lit(radius)) if isinstance(radius, int) else pixels.join(radius.select("image", F.col("radius").alias("_r")), "image")
    seeds = own.where("seed <> 0")
    near = [f("seed", 1).over(_along(axis)) for axis in "xy" for f in (F.lag, F.lead)]
    inner = F.lit(True)
    for n in near:
        inner = inner & (F.coalesce(n, F.col("seed")) == F.col("seed"))
    rim = own.withColumn("_inner", inner).where("seed <> 0 and not _inner")
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    cell = lambda c: F.floor(F.col(c) / F.greatest("_r", F.lit(1)))
    spread = rim.select("image", F.col("seed").alias("label"), F.col("y").alias("sy"), F.col("x").alias("sx"), around.alias("o"), cell("y").alias("cy"), cell("x").alias("cx")).select("image", "label", "sy", "sx", (F.col("cy") + F.col("o.a")).alias("cy"), (F.col("cx") + F.col("o.b")).alias("cx"))
    ground = own.where("seed = 0").withColumn("cy", cell("y")).withColumn("cx", cell("x"))
    d = (F.col("y") - F.col("sy")) * (F.col("y") - F.col("sy")) + (F.col("x") - F.col("sx")) * (F.col("x") - F.col("sx"))
    near = ground.join(spread, ["image", "cy", "cx"]).where(d < F.col("_r") * F.col("_r")).groupBy("image", "y", "x").agg(F.min(F.struct(d.alias("d"), "label")).alias("b"))
    assigned = ground.select("image", "y", "x").join(near, ["image", "y", "x"], "left").select("image", "y", "x", F.coalesce("b.label", F.lit(0)).alias("label"))
    kept = seeds.select("image", "y", "x", (F.lit(0) if drop_nucleus else F.col("seed")).alias("label"))
    return assigned.unionByName(kept)


def cell_mean_image(pixels: DataFrame, cells: DataFrame) -> DataFrame:
    """Each pixel with the mean of its cell."""
    return pixels.select("image", "y", "x", "label_id").join(cells.select("image", "label_id", "means"), ["image", "label_id"])


def cell_masks(labels: DataFrame, flags: DataFrame) -> DataFrame:
    """code: 3 outlier cell, 2 edge, 1 infected cell, else 0."""
    own = seg_edges(labels).join(flags.select("image", "label_id", "is_infected", "is_outlier"), ["image", "label_id"], "left")
    return own.withColumn("code", F.when(F.col("is_outlier") == 1, 3).when(F.col("edge") == 1, 2).when(F.col("is_infected") == 1, 1).otherwise(0)).drop("is_infected", "is_outlier", "edge")


def relabel(labels: DataFrame) -> DataFrame:
    """Labels renumbered without gaps in each image: distinct labels are ranked and joined back."""
    rank = F.dense_rank().over(Window.partitionBy("image").orderBy("label_id")) - 1
    numbers = labels.select("image", "label_id").distinct().withColumn("new_label", rank)
    return labels.join(numbers, ["image", "label_id"])


def size_filter(labels: DataFrame, smallest: int = 100) -> DataFrame:
    """Segments below the size become 0, the rest are renumbered."""
    sizes = labels.groupBy("image", "label_id").agg(F.count("*").alias("_n"))
    kept = labels.join(sizes, ["image", "label_id"]).withColumn("label_id", F.when(F.col("_n") >= smallest, F.col("label_id")).otherwise(0)).drop("_n")
    return relabel(kept)


def classes_by_size(labels: DataFrame, classes: tuple[int, ...] = (0, 2, 1)) -> DataFrame:
    """The largest segment of an image is class 0, the next ones as listed, the others 0."""
    sizes = labels.groupBy("image", "label_id").agg(F.count("*").alias("size"))
    place = F.row_number().over(Window.partitionBy("image").orderBy(F.desc("size"), "label_id"))
    return sizes.select("image", "label_id", "size", F.coalesce(F.get(F.array(*[F.lit(c) for c in classes]), place - 1), F.lit(0)).alias("class"))


def corrected_classes(labels: DataFrame, classes: DataFrame, marks: DataFrame) -> DataFrame:
    """image, label_id, class: an annotator's mark on any pixel of a cell overrides its class; of several the largest."""
    marked = labels.join(marks, ["image", "y", "x"]).groupBy("image", "label_id").agg(F.max("mark").alias("_m"))
    return classes.join(marked, ["image", "label_id"], "left").withColumn("class", F.coalesce("_m", "class")).drop("_m")


def threshold(v: Column, at: float, below: bool = False) -> Column:
    return ((v < at) if below else (v > at)).cast("int")
