"""Pixel operators, overlaps, tests and curves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import evaluate, grid_search, hooks, learn, pixels, scores
from ..operators.grids import Grid
from ..sources import readers, sinks
from ..sources.scratch import shared_folder
from .registry import Tables, normal_sql, query, r, six, student_sql

#: A pixel's integer value in 0..99, the same in both engines, and images of one size.
LEVELS = "lv AS (SELECT image, y, x, (floor(v * 200) % 50 + 50)::DOUBLE v, label_id FROM pixels)"
ROW, COL = "(PARTITION BY image, y ORDER BY x)", "(PARTITION BY image, x ORDER BY y)"


def image_levels(t: Tables):
    """image, y, x, v with whole numbers, so that sums and ties are exact."""
    return t.pixels.select("image", "y", "x", (F.floor(F.col("v") * 200) % 50 + 50).cast("double").alias("v"), "label_id")


def disk_sql(source: str, name: str, radius: int, fn: str, value: str = "v") -> str:
    """A disk's least or largest value by all pairs of pixels that are within it."""
    return f"{name} AS (SELECT a.image, a.y, a.x, {fn}(b.{value}) {value} FROM {source} a JOIN {source} b ON a.image = b.image AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= {radius * radius} GROUP BY a.image, a.y, a.x)"


EDGES = f"""ed AS (SELECT image, y, x, label_id, (coalesce(lag(label_id) OVER {ROW}, label_id) <> coalesce(lead(label_id) OVER {ROW}, label_id) OR coalesce(lag(label_id) OVER {COL}, label_id) <> coalesce(lead(label_id) OVER {COL}, label_id))::INT edge FROM pixels)"""
PIXEL = "image, y::BIGINT y, x::BIGINT x"


@query("W1_seg_edges", f"SELECT {PIXEL}, edge::BIGINT edge FROM ed", EDGES)
def w1(t: Tables):
    return pixels.seg_edges(t.pixels).select("image", "y", "x", "edge")


@query("W2_erode_labels", f"SELECT {PIXEL}, CASE WHEN near.edge = 1 THEN 0 ELSE label_id END::BIGINT label_id FROM pixels JOIN near USING (image, y, x)", EDGES + ", " + disk_sql("ed", "near", 1, "max", "edge"))
def w2(t: Tables):
    return pixels.erode_labels(t.pixels, 2).select("image", "y", "x", "label_id")


OPENING = f"{LEVELS}, {disk_sql('lv', 'er', 2, 'min')}, {disk_sql('er', 'op', 2, 'max')}"


@query("W3_gray_opening", f"SELECT {PIXEL}, v FROM op", OPENING)
def w3(t: Tables):
    return pixels.gray_opening(image_levels(t), 2).select("image", "y", "x", "v")


def disk_opening(radius: int):
    """An opening as a function of an array, as someone may bring it along."""

    def extreme(v, pick, fill):
        p = np.pad(v, radius, constant_values=fill)
        near = [(y, x) for y in range(-radius, radius + 1) for x in range(-radius, radius + 1) if y * y + x * x <= radius * radius]
        return pick([p[radius + y : radius + y + v.shape[0], radius + x : radius + x + v.shape[1]] for y, x in near], axis=0)

    return lambda v: extreme(extreme(v, np.min, np.inf), np.max, -np.inf)


@query("F3_own_denoiser", f"SELECT {PIXEL}, v FROM op", OPENING)
def f3(t: Tables):
    """The same opening by an own function, on blocks of 5 x 5 with a halo of twice the radius."""
    return hooks.denoised(image_levels(t), disk_opening(2), 4, keys=("image",), block=5)


@query("F4_own_normaliser", f"SELECT {PIXEL}, {r('(v - avg(v) OVER (PARTITION BY image)) / (max(v) OVER (PARTITION BY image) + 1)', 'v')} FROM lv", LEVELS)
def f4(t: Tables):
    return hooks.normalised(image_levels(t), lambda v: (v - v.mean()) / (v.max() + 1), keys=("image",))


@query("W4_white_tophat", f"SELECT {PIXEL}, lv.v - op.v v FROM lv JOIN op USING (image, y, x)", OPENING)
def w4(t: Tables):
    return pixels.white_tophat(image_levels(t), 2).select("image", "y", "x", "v")


def cross_sql(source: str, name: str, fn: str) -> str:
    near = ", ".join(f"coalesce({f}(m) OVER {w}, 0)" for w in (ROW, COL) for f in ("lag", "lead"))
    return f"{name} AS (SELECT image, y, x, {fn}(m, {near}) m FROM {source})"


OPEN_CLOSE = f"{LEVELS}, m0 AS (SELECT image, y, x, (v > 60)::INT m FROM lv), " + ", ".join(cross_sql(f"m{k}", f"m{k + 1}", fn) for k, fn in enumerate(["least"] * 2 + ["greatest"] * 4 + ["least"] * 2))


@query("W5_binary_open_close", f"SELECT {PIXEL}, m::BIGINT m FROM m8", OPEN_CLOSE)
def w5(t: Tables):
    mask = image_levels(t).select("image", "y", "x", pixels.threshold(F.col("v"), 60).alias("m"))
    return pixels.open_close(mask)


@query("W6_standardize", f"SELECT {PIXEL}, {r('(v - avg(v) OVER (PARTITION BY image)) / greatest(stddev_pop(v) OVER (PARTITION BY image), 1e-6)', 'v')} FROM lv", LEVELS)
def w6(t: Tables):
    return pixels.standardize(image_levels(t)).select("image", "y", "x", "v")


@query("W7_minmax_normalize", f"SELECT {PIXEL}, {r('(v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-6)', 'v')} FROM lv WINDOW w AS (PARTITION BY image)", LEVELS)
def w7(t: Tables):
    return pixels.minmax(image_levels(t)).select("image", "y", "x", "v")


@query("W7_to_uint8", f"SELECT {PIXEL}, floor((v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-6) * 255)::BIGINT v FROM lv WINDOW w AS (PARTITION BY image)", LEVELS)
def w7_byte(t: Tables):
    return pixels.to_uint8(image_levels(t)).select("image", "y", "x", "v")


@query("W8_percentile_normalize", f"SELECT {PIXEL}, {r('greatest(0, least(1, (v - lo) / (hi - lo + 1e-6)))', 'v')} FROM lv JOIN (SELECT image, quantile_cont(v, 0.03) lo, quantile_cont(v, 0.998) hi FROM lv GROUP BY image) USING (image)", LEVELS)
def w8(t: Tables):
    return pixels.percentile_normalize(image_levels(t), clip=True).select("image", "y", "x", "v")


@query("W8_quantile_normalize", f"SELECT {PIXEL}, {r('greatest(0, least(1, (v - lo) / nullif(hi, 0)))', 'v')} FROM lv JOIN (SELECT image, quantile_cont(v, 0.01) lo, quantile_cont(v, 0.99) hi FROM lv GROUP BY image) USING (image)", LEVELS)
def w8_quantile(t: Tables):
    return pixels.quantile_normalize(image_levels(t)).select("image", "y", "x", "v")


@query("A41_contrast_limits", f"SELECT image, {r('quantile_cont(v, 0.01)', 'low')}, {r('quantile_cont(v, 0.99)', 'high')} FROM lv GROUP BY image", LEVELS)
def a41(t: Tables):
    return pixels.contrast_limits(image_levels(t))


@query("A16_downscale", f"SELECT image, (y // 3)::BIGINT y, (x // 3)::BIGINT x, {r('avg(v)', 'v')} FROM lv WHERE y < 6 AND x < 6 GROUP BY ALL", LEVELS)
def a16(t: Tables):
    return pixels.downscale(image_levels(t), 3)


@query("A16_downscale_labels", "SELECT image, (y // 3)::BIGINT y, (x // 3)::BIGINT x, label_id::BIGINT label_id FROM pixels WHERE y % 3 = 0 AND x % 3 = 0")
def a16_labels(t: Tables):
    return pixels.downscale_labels(t.pixels.select("image", "y", "x", "label_id"), 3)


@query("K2_write_pyramid", f"SELECT image, y::BIGINT y, x::BIGINT x, v, 0::BIGINT scale FROM lv UNION ALL SELECT image, y // 2, x // 2, avg(v), 1 FROM lv GROUP BY ALL UNION ALL SELECT image, y // 4, x // 4, avg(v), 2 FROM lv GROUP BY ALL", LEVELS)
def k2(t: Tables):
    return sinks.pyramid(image_levels(t), [2, 2])


@query("S2_read_channel", f"SELECT {PIXEL}, v FROM lv", LEVELS)
def s2(t: Tables):
    both = image_levels(t).withColumn("channel", F.explode(F.array(F.lit("marker"), F.lit("serum")))).withColumn("scale", F.lit(0))
    return readers.channel(both, "serum").select("image", "y", "x", "v")


@query("P6_illumination_correct", f"SELECT {PIXEL}, {r('(v - 5) / (1 + y * 0.1::DOUBLE + x * 0.01::DOUBLE) + 5', 'v')} FROM lv", LEVELS)
def p6(t: Tables):
    corrector = t.pixels.select("y", "x").distinct().select(F.lit("serum").alias("channel"), "y", "x", F.lit(5.0).alias("offset"), (1 + F.col("y") * 0.1 + F.col("x") * 0.01).alias("divisor"))
    return pixels.illumination_correct(image_levels(t).withColumn("channel", F.lit("serum")), corrector).select("image", "y", "x", "v")


@query("P13_threshold_channel", f"SELECT {PIXEL}, (v > 70)::INT::BIGINT is_over, (v < 60)::INT::BIGINT is_under FROM lv", LEVELS)
def p13(t: Tables):
    return image_levels(t).select("image", "y", "x", pixels.threshold(F.col("v"), 70).alias("is_over"), pixels.threshold(F.col("v"), 60, below=True).alias("is_under"))


@query("P14_keep_channels", f"SELECT {PIXEL}, 'mask' channel, v FROM lv UNION ALL SELECT {PIXEL}, 'rim', v / 2 FROM lv", LEVELS)
def p14(t: Tables):
    names = {"c0": ("mask", 1), "c1": (None, 1), "c2": ("rim", 2)}
    rows = image_levels(t).select("image", "y", "x", F.explode(F.array(*[F.struct(F.lit(k).alias("raw"), (F.col("v") / d).alias("v")) for k, (_, d) in names.items()])).alias("s"))
    new = F.create_map(*[F.lit(x) for k, (n, _) in names.items() if n for x in (k, n)])
    return rows.where(F.col("s.raw").isin("c0", "c2")).select("image", "y", "x", new[F.col("s.raw")].alias("channel"), "s.v")


@query("A39_corrector_estimate", f"SELECT 'serum' channel, y::BIGINT y, x::BIGINT x, count(*) n, {r('avg(s)', 'mean')}, {r('var_pop(s)', 'variance')} FROM (SELECT y, x, v / avg(v) OVER (PARTITION BY image) s FROM lv JOIN pixel_flags USING (image) WHERE is_outlier = 0) GROUP BY y, x", LEVELS)
def a39(t: Tables):
    return pixels.estimate_corrector(image_levels(t).withColumn("channel", F.lit("serum")), t.pixel_flags)


WEIGHT = "exp(-((a.{c} - b.{c}) ** 2) / 2.0::DOUBLE)"


def blur_sql(source: str, name: str, axis: str) -> str:
    other = "y" if axis == "x" else "x"
    w = WEIGHT.format(c=axis)
    return f"{name} AS (SELECT a.image, a.y, a.x, sum(b.v * {w}) / sum({w}) v FROM {source} a JOIN {source} b ON a.image = b.image AND a.{other} = b.{other} AND abs(a.{axis} - b.{axis}) <= 3 GROUP BY a.image, a.y, a.x)"


PLATES = f"""pm AS (SELECT plate, y, x, count(*) n, avg(lv.v) m FROM lv JOIN (SELECT DISTINCT image, plate FROM pixels) USING (image) JOIN pixel_flags USING (image) WHERE is_outlier = 0 GROUP BY ALL),
ps AS (SELECT y, x, 0 image, n, (m - 20) / avg(m - 20) OVER (PARTITION BY plate) s FROM pm), pw AS (SELECT image, y, x, sum(n * s) / sum(n) v FROM ps GROUP BY ALL)"""


@query("A39_corrector_of_plates", f"SELECT 'serum' channel, y::BIGINT y, x::BIGINT x, 20.0::DOUBLE AS \"offset\", {r('v', 'divisor')} FROM b2", f"{LEVELS}, {PLATES}, {blur_sql('pw', 'b1', 'x')}, {blur_sql('b1', 'b2', 'y')}")
def a39_plates(t: Tables):
    """Moments of two halves of the images, merged, then the weighted and smoothed map."""
    rows = image_levels(t).join(t.pixels.select("image", "plate").distinct(), "image").withColumn("channel", F.lit("serum"))
    halves = [pixels.corrector_moments(rows.where(F.col("image") % 2 == k), t.pixel_flags) for k in (0, 1)]
    return pixels.corrector(pixels.merged_moments(halves[0].unionByName(halves[1])), 20.0, 1.0)


@query("A39_merged_moments", f"SELECT plate, 'serum' channel, y::BIGINT y, x::BIGINT x, count(*) n, {r('avg(lv.v)', 'mean')}, {r('var_pop(lv.v) * count(*)', 'm2')} FROM lv JOIN (SELECT DISTINCT image, plate FROM pixels) USING (image) JOIN pixel_flags USING (image) WHERE is_outlier = 0 GROUP BY ALL", LEVELS)
def a39_moments(t: Tables):
    rows = image_levels(t).join(t.pixels.select("image", "plate").distinct(), "image").withColumn("channel", F.lit("serum"))
    halves = [pixels.corrector_moments(rows.where(F.col("image") % 2 == k), t.pixel_flags) for k in (0, 1)]
    return pixels.merged_moments(halves[0].unionByName(halves[1]))


@query("X2_cell_mean_image", f"SELECT {PIXEL}, label_id::BIGINT label_id, {r('avg(v) OVER (PARTITION BY image, label_id)', 'means')} FROM pixels")
def x2(t: Tables):
    from ..operators.features import cell_features

    return pixels.cell_mean_image(t.pixels, cell_features(t.pixels))


FLAGS = "(image + label_id) % 3 = 0 AND label_id <> 0"


@query("X3_cell_masks", f"SELECT {PIXEL}, label_id::BIGINT label_id, CASE WHEN (image + label_id) % 5 = 0 THEN 3 WHEN edge = 1 THEN 2 WHEN {FLAGS} THEN 1 ELSE 0 END::BIGINT code FROM ed", EDGES)
def x3(t: Tables):
    flags = t.pixels.select("image", "label_id").distinct().selectExpr("image", "label_id", f"cast({FLAGS} as int) AS is_infected", "cast((image + label_id) % 5 = 0 as int) AS is_outlier")
    return pixels.cell_masks(t.pixels.select("image", "y", "x", "label_id"), flags)


@query("X4_gaussian_blur", f"SELECT {PIXEL}, {r('v', 'v')} FROM b2", f"{LEVELS}, {blur_sql('lv', 'b1', 'x')}, {blur_sql('b1', 'b2', 'y')}")
def x4(t: Tables):
    return pixels.blur(image_levels(t), 1.0).select("image", "y", "x", "v")


@query("X5_cell_outline", f"SELECT p.image, p.y::BIGINT y, p.x::BIGINT x, CASE WHEN bool_or(q.label_id <> p.label_id) THEN p.label_id ELSE 0 END::BIGINT outline FROM pixels p JOIN pixels q ON p.image = q.image AND abs(p.y - q.y) + abs(p.x - q.x) <= 1 GROUP BY p.image, p.y, p.x, p.label_id")
def x5(t: Tables):
    return pixels.cell_outline(t.pixels.select("image", "y", "x", "label_id"), 1).drop("label_id")


SEEDS = f"{LEVELS}, sm AS (SELECT image, y, x, (v > 55)::INT mask, CASE WHEN v > 94 THEN label_id + 1 ELSE 0 END seed FROM lv), {disk_sql('sm', 'me', 1, 'min', 'mask')}, {disk_sql('sm', 'sd', 1, 'max', 'seed')}"


@query("X6_seed_mask_prepare", f"SELECT {PIXEL}, greatest(me.mask, (sd.seed > 0)::INT)::BIGINT mask, sd.seed::BIGINT seed FROM me JOIN sd USING (image, y, x)", SEEDS)
def x6(t: Tables):
    rows = image_levels(t).select("image", "y", "x", pixels.threshold(F.col("v"), 55).alias("mask"), F.when(F.col("v") > 94, F.col("label_id") + 1).otherwise(0).alias("seed"))
    return pixels.prepare_seeds(rows, 1, 1)


@query("X7_apply_label_correction", "SELECT image, label_id::BIGINT label_id, coalesce(m, label_id % 2)::BIGINT \"class\" FROM (SELECT DISTINCT image, label_id FROM pixels) LEFT JOIN (SELECT image, label_id, max(x % 3) m FROM pixels WHERE image % 4 = 0 AND x < 3 GROUP BY ALL) USING (image, label_id)")
def x7(t: Tables):
    classes = t.pixels.select("image", "label_id").distinct().withColumn("class", F.col("label_id") % 2)
    marks = t.pixels.where("image % 4 = 0 and x < 3").select("image", "y", "x", (F.col("x") % 3).alias("mark"))
    return pixels.corrected_classes(t.pixels, classes, marks)


@query("J17_nearest_seed", f"""SELECT {PIXEL}, label::BIGINT label FROM (SELECT g.image, g.y, g.x, coalesce(arg_min(s.seed, ((g.y - s.y) ** 2 + (g.x - s.x) ** 2, s.seed)), 0) label FROM sm g LEFT JOIN sm s ON s.image = g.image AND s.seed <> 0 AND (g.y - s.y) ** 2 + (g.x - s.x) ** 2 < 9 WHERE g.seed = 0 GROUP BY g.image, g.y, g.x)
UNION ALL SELECT {PIXEL}, seed::BIGINT FROM sm WHERE seed <> 0""", f"{LEVELS}, sm AS (SELECT image, y, x, CASE WHEN v > 90 THEN label_id + 1 ELSE 0 END seed FROM lv)")
def j17(t: Tables):
    rows = image_levels(t).select("image", "y", "x", F.when(F.col("v") > 90, F.col("label_id") + 1).otherwise(0).alias("seed"))
    return pixels.nearest_seed(rows, 3)


@query("J17_ring_radius", f"""SELECT {PIXEL}, label::BIGINT label FROM (SELECT g.image, g.y, g.x, coalesce(arg_min(s.seed, ((g.y - s.y) ** 2 + (g.x - s.x) ** 2, s.seed)), 0) label FROM sm g JOIN rr ON rr.image = g.image LEFT JOIN sm s ON s.image = g.image AND s.seed <> 0 AND (g.y - s.y) ** 2 + (g.x - s.x) ** 2 < radius ** 2 WHERE g.seed = 0 GROUP BY g.image, g.y, g.x)
UNION ALL SELECT {PIXEL}, 0 FROM sm WHERE seed <> 0""", f"{LEVELS}, sm AS (SELECT image, y, x, CASE WHEN v > 90 THEN label_id + 1 ELSE 0 END seed FROM lv), rr AS (SELECT image, coalesce(floor(1.3::DOUBLE * sqrt(median(n) FILTER (WHERE seed <> 0))), 0)::BIGINT radius FROM (SELECT image, seed, count(*) n FROM sm GROUP BY ALL) GROUP BY image)")
def j17_radius(t: Tables):
    """Rings without the nuclei, as wide as each image's nuclei tell."""
    rows = image_levels(t).select("image", "y", "x", F.when(F.col("v") > 90, F.col("label_id") + 1).otherwise(0).alias("seed"))
    return pixels.nearest_seed(rows, pixels.ring_radius(rows, 1.3), drop_nucleus=True)


#: A second segmentation, shifted by a column, and the overlaps of both.
PAIRS = "pr AS (SELECT a.image, a.label_id gt, b.label_id seg, count(*) n FROM pixels a JOIN pixels b ON a.image = b.image AND a.y = b.y AND b.x = (a.x + a.image % 4) % 8 GROUP BY ALL)"
METRICS = f"""{PAIRS}, io AS (SELECT image, gt, seg, n::DOUBLE / (sum(n) OVER (PARTITION BY image, gt) + sum(n) OVER (PARTITION BY image, seg) - n) iou FROM pr),
th AS (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]::DOUBLE[]) threshold), sz AS (SELECT image, count(DISTINCT gt) FILTER (WHERE gt <> 0) ng, count(DISTINCT seg) FILTER (WHERE seg <> 0) ns FROM pr GROUP BY image),
me AS (SELECT image, threshold, coalesce(any_value(ng), 0) ng, coalesce(any_value(ns), 0) ns, count(DISTINCT gt) FILTER (WHERE iou >= threshold AND gt <> 0 AND seg <> 0) tp, count(DISTINCT seg) FILTER (WHERE iou >= threshold AND gt <> 0 AND seg <> 0) hit FROM th, io JOIN sz USING (image) GROUP BY image, threshold)"""


def pairs(t: Tables):
    gt = t.pixels.select("image", "y", "x", F.col("label_id").alias("gt"))
    seg = t.pixels.select("image", "y", ((F.col("x") - F.col("image") % 4 + 8) % 8).cast("int").alias("x"), F.col("label_id").alias("seg"))
    return evaluate.overlaps(gt, seg)


@query("J15_label_overlap", "SELECT image, gt::BIGINT gt, seg::BIGINT seg, n FROM pr", PAIRS)
def j15(t: Tables):
    return pairs(t)


THRESHOLDS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]


@query("A26_iou_metrics", f"SELECT image, threshold, tp, ns - hit fp, ng - tp fn, {r('tp / nullif(tp + ns - hit, 0)', 'precision')}, {r('tp / nullif(ng, 0)', 'recall')}, {r('tp / nullif(ns - hit + ng, 0)', 'accuracy')}, {r('2 * tp / nullif(tp + ns - hit + ng, 0)', 'f1')} FROM me", METRICS)
def a26(t: Tables):
    grid = Grid(threshold=THRESHOLDS)

    @grid.step(rows=("threshold",))
    def metrics(threshold):
        return evaluate.segmentation_metrics(pairs(t), threshold)

    return grid.table("metrics")


@query("A27_mean_ap", f"SELECT image, {r('avg(tp / nullif(ns - hit + ng, 0))', 'mean_ap')} FROM me GROUP BY image", METRICS)
def a27(t: Tables):
    return evaluate.mean_ap(evaluate.segmentation_metrics(pairs(t), THRESHOLDS))


@query("A28_cv_summary", f"SELECT {r('avg(a)', 'mean')}, {r('stddev_pop(a)', 'std')} FROM (SELECT image % 10 fold, avg(tp / nullif(ns - hit + ng, 0)) a FROM me WHERE threshold = 0.5 GROUP BY 1)", METRICS)
def a28(t: Tables):
    folds = evaluate.segmentation_metrics(pairs(t), [0.5]).groupBy(F.col("image") % 10).agg(F.avg("accuracy").alias("accuracy"))
    return evaluate.fold_summary(folds)


@query("A29_majority_label", "SELECT image, gt::BIGINT gt, max_by(seg, (n, -seg))::BIGINT majority FROM pr WHERE gt <> 0 GROUP BY image, gt", PAIRS)
def a29(t: Tables):
    return evaluate.majority_label(pairs(t))


@query("A29_majority_nonzero", "SELECT image, gt::BIGINT gt, max_by(seg, ((seg <> 0)::INT, n, -seg))::BIGINT majority FROM pr WHERE gt <> 0 GROUP BY image, gt", PAIRS)
def a29_nonzero(t: Tables):
    return evaluate.majority_label(pairs(t), prefer_nonzero=True)


SEGMENTS = "sg AS (SELECT image, y, x, (image * 3 + y // 2 * (x // 3 + 1)) % 6 label_id FROM pixels)"


def segments(t: Tables):
    return t.pixels.select("image", "y", "x", ((F.col("image") * 3 + F.floor(F.col("y") / 2) * (F.floor(F.col("x") / 3) + 1)) % 6).alias("label_id"))


@query("A42_size_rank_relabel", "SELECT image, label_id, n size, CASE row_number() OVER (PARTITION BY image ORDER BY n DESC, label_id) WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END::BIGINT \"class\" FROM (SELECT image, label_id, count(*) n FROM sg GROUP BY ALL)", SEGMENTS)
def a42(t: Tables):
    return pixels.classes_by_size(segments(t))


@query("A43_size_filter", f"SELECT {PIXEL}, label_id, (dense_rank() OVER (PARTITION BY image ORDER BY label_id) - 1)::BIGINT new_label FROM (SELECT image, y, x, CASE WHEN count(*) OVER (PARTITION BY image, label_id) >= 10 THEN label_id ELSE 0 END label_id FROM sg)", SEGMENTS)
def a43(t: Tables):
    return pixels.size_filter(segments(t), 10)


@query("W13_consecutive_relabel", f"SELECT {PIXEL}, label_id, (dense_rank() OVER (PARTITION BY image ORDER BY label_id) - 1)::BIGINT new_label FROM sg", SEGMENTS)
def w13(t: Tables):
    return pixels.relabel(segments(t))


MASKS = f"{LEVELS}, mk AS (SELECT image, v, CASE WHEN label_id = 1 THEN 1 WHEN label_id = 2 THEN 2 ELSE 0 END mask FROM lv), pa AS (SELECT image, avg(v) FILTER (WHERE mask = 1) a, avg(v) FILTER (WHERE mask = 2) b, avg(v) FILTER (WHERE mask = 0) g FROM mk GROUP BY image)"


def ratio_sql(n: str, d: str, name: str) -> str:
    return r(f"CASE WHEN {d} <> 0 THEN ({n}) / ({d}) ELSE 0 END", name)


def masked(t: Tables):
    return image_levels(t).withColumn("mask", F.when(F.col("label_id").isin(1, 2), F.col("label_id")).otherwise(0))


@query("A21_pixel_analysis", f"SELECT image, {r('a', 'infected_mean')}, {r('b', 'control_mean')}, {r('g', 'background_mean')}, {ratio_sql('a', 'b', 'ratio')}, {ratio_sql('a - b', 'a + b', 'dos')}, {ratio_sql('a - g', 'b - g', 'ratio_wo_bg')}, {ratio_sql('a - b', 'a + b - 2 * g', 'dos_wo_bg')} FROM pa", MASKS)
def a21(t: Tables):
    return scores.pixel_analysis(masked(t), ["image"])


def two_masks(t: Tables):
    return masked(t).where("mask in (1, 2)").withColumn("group", (F.col("mask") == 1).cast("int"))


@query("A22_ks_2samp", f"SELECT image, {r('max(abs(f1 - f0))', 'ks')} FROM (SELECT image, count(*) FILTER (WHERE mask = 1) OVER w / 16.0::DOUBLE f1, count(*) FILTER (WHERE mask = 2) OVER w / 16.0::DOUBLE f0 FROM mk WHERE mask > 0 WINDOW w AS (PARTITION BY image ORDER BY v RANGE UNBOUNDED PRECEDING)) GROUP BY image", MASKS)
def a22(t: Tables):
    return stats.ks(two_masks(t), ["image"], "v", "group")


@query("A23_ranksum", f"SELECT image, {r('(sum(k) FILTER (WHERE mask = 1) - 16 * 33 / 2.0::DOUBLE) / sqrt(16 * 16 * 33 / 12.0::DOUBLE)', 'z')} FROM (SELECT image, mask, rank() OVER (PARTITION BY image ORDER BY v) + (count(*) OVER (PARTITION BY image, v) - 1) / 2.0::DOUBLE k FROM mk WHERE mask > 0) GROUP BY image", MASKS)
def a23(t: Tables):
    return stats.ranksum(two_masks(t), ["image"], "v", "group")


RANKS = "rk AS (SELECT image, (sum(k) FILTER (WHERE mask = 1) - 16 * 33 / 2.0::DOUBLE) / sqrt(16 * 16 * 33 / 12.0::DOUBLE) z FROM (SELECT image, mask, rank() OVER (PARTITION BY image ORDER BY v) + (count(*) OVER (PARTITION BY image, v) - 1) / 2.0::DOUBLE k FROM mk WHERE mask > 0) GROUP BY image)"


@query("A23_ranksum_p_value", f"SELECT image, {r('z', 'z')}, {r(normal_sql('z'), 'p')} FROM rk", f"{MASKS}, {RANKS}")
def a23_p(t: Tables):
    return a23(t).withColumn("p", stats.rank_test_p("z"))


#: The Kolmogorov series at sqrt(16 * 16 / 32) times the distance.
KOLMOGOROV = "least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * j * j * 8 * ks * ks)))))"
TESTS = f"""{RANKS}, kk AS (SELECT image, max(abs(f1 - f0)) ks FROM (SELECT image, count(*) FILTER (WHERE mask = 1) OVER w / 16.0::DOUBLE f1, count(*) FILTER (WHERE mask = 2) OVER w / 16.0::DOUBLE f0 FROM mk WHERE mask > 0 WINDOW w AS (PARTITION BY image ORDER BY v RANGE UNBOUNDED PRECEDING)) GROUP BY image),
ww AS (SELECT image, (m1 - m0) / sqrt(v1 / 16 + v0 / 16) t, (v1 / 16 + v0 / 16) ** 2 / ((v1 / 16) ** 2 / 15 + (v0 / 16) ** 2 / 15) dof FROM (SELECT image, avg(v) FILTER (WHERE mask = 1) m1, avg(v) FILTER (WHERE mask = 2) m0, var_samp(v) FILTER (WHERE mask = 1) v1, var_samp(v) FILTER (WHERE mask = 2) v0 FROM mk GROUP BY image))"""


@query("A21_pixel_tests", f"SELECT image, 16::BIGINT n_infected, 16::BIGINT n_control, {r('ks', 'ks')}, {r(KOLMOGOROV, 'ks_p')}, {r('t', 't')}, {r(student_sql('t', 'dof'), 'welch_p')}, {r('z', 'z')}, {r(normal_sql('z'), 'ranksum_p')} FROM kk JOIN ww USING (image) JOIN rk USING (image)", f"{MASKS}, {TESTS}")
def a21_tests(t: Tables):
    return scores.pixel_tests(masked(t), ["image"])


PREDICTED = "pd AS (SELECT image, plate, label_id, threshold, (label_id <> 0 AND NOT marker > dev * threshold + med)::INT p, (tag <> 1)::INT tr FROM cells JOIN bg USING (plate), (SELECT unnest([0.05, 0.55, 1.05, 2.05]::DOUBLE[]) threshold)), cf AS (SELECT plate, threshold, count(*) FILTER (WHERE p = 1 AND tr = 1) tp, count(*) FILTER (WHERE p = 1 AND tr = 0) fp, count(*) FILTER (WHERE p = 0 AND tr = 0) tn, count(*) FILTER (WHERE p = 0 AND tr = 1) fn FROM pd WHERE label_id <> 0 GROUP BY ALL)"
F_SCORE = "2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0)"


def grid_confusion(t: Tables):
    from ..operators import classify
    from ..plans.plate_analysis import marker_background

    cells = t.cells.withColumn("truth_control", (F.col("tag") != 1).cast("int"))
    counts = classify.grid_counts(cells, marker_background(cells), ["plate"], [0.05, 0.55, 1.05, 2.05], ["truth_control"])
    return evaluate.confusion_of_counts(counts, ["plate", "threshold"])


@query("A24_confusion_fscore", f"SELECT plate, threshold, tp, fp, tn, fn, {r('tp / nullif(tp + fp, 0)', 'precision')}, {r('tp / nullif(tp + fn, 0)', 'recall')}, {r(F_SCORE, 'f_score')}, {r('(tp + tn) / nullif(tp + tn + fp + fn, 0)', 'accuracy')} FROM cf", PREDICTED)
def a24(t: Tables):
    return grid_confusion(t)


@query("A25_grid_scores", f"SELECT plate, threshold, {r(F_SCORE, 'f_score')} FROM cf QUALIFY row_number() OVER (PARTITION BY plate ORDER BY {F_SCORE} DESC NULLS LAST, threshold) = 1", PREDICTED)
def a25(t: Tables):
    return evaluate.best_of_grid(grid_confusion(t), ["plate"], "f_score", ["threshold"]).select("plate", "threshold", "f_score")


#: Two values of each axis of the search: segmentations, pixels of nuclei, opening radii, quantiles, thresholds.
GRID = f"""{LEVELS}, {disk_sql("lv", "ge", 1, "min")}, {disk_sql("ge", "go", 1, "max")}, {EDGES}, 
dn AS (SELECT image, y, x, v, 0 denoise_radius FROM lv UNION ALL SELECT image, y, x, v, 1 FROM go), sgm AS (SELECT image, y, x, label_id, 'cells' segmentation FROM pixels UNION ALL SELECT p.image, p.y, p.x, CASE WHEN edge = 1 THEN 0 ELSE label_id END, 'eroded' FROM ed p),
nu AS (SELECT image, y, x, v > 80 AND v < 95 inside FROM lv),
pc AS (SELECT sgm.*, dn.v, denoise_radius, ign ignore_nuclei FROM sgm JOIN dn USING (image, y, x) JOIN nu USING (image, y, x), (SELECT unnest([true, false]) ign) WHERE NOT ign OR NOT inside OR label_id = 0),
gb AS (SELECT segmentation, denoise_radius, ignore_nuclei, image, median(v) med, mad(v) dev FROM pc WHERE label_id = 0 GROUP BY ALL),
gq AS (SELECT segmentation, denoise_radius, ignore_nuclei, image, label_id, 0.5::DOUBLE quantile, quantile_cont(v, 0.5) marker FROM pc WHERE label_id <> 0 GROUP BY ALL UNION ALL SELECT segmentation, denoise_radius, ignore_nuclei, image, label_id, 0.9::DOUBLE, quantile_cont(v, 0.9) FROM pc WHERE label_id <> 0 GROUP BY ALL),
gp AS (SELECT gq.*, threshold, (NOT marker > dev * threshold + med)::INT p, ((image + label_id) % 3 <> 0)::INT tr FROM gq JOIN gb USING (segmentation, denoise_radius, ignore_nuclei, image), (SELECT unnest([0.5, 1.5]::DOUBLE[]) threshold)),
gc AS (SELECT segmentation, denoise_radius, ignore_nuclei, quantile, threshold, image, count(*) FILTER (WHERE p = 1 AND tr = 1) tp, count(*) FILTER (WHERE p = 1 AND tr = 0) fp, count(*) FILTER (WHERE p = 0 AND tr = 0) tn, count(*) FILTER (WHERE p = 0 AND tr = 1) fn FROM gp GROUP BY ALL),
gf AS (SELECT *, coalesce({F_SCORE}, 0) f FROM gc), gs AS (SELECT segmentation, denoise_radius, ignore_nuclei, quantile, threshold, count(*) n_images, avg(f) f_score FROM gf GROUP BY ALL)"""


def marker_grid(t: Tables):
    cells = t.pixels.select("image", "y", "x", "label_id")
    nuclei = image_levels(t).select("image", "y", "x", ((F.col("v") > 80) & (F.col("v") < 95)).cast("int").alias("label_id"))
    truth = cells.where("label_id <> 0").select("image", "label_id").distinct().withColumn("truth_control", ((F.col("image") + F.col("label_id")) % 3 != 0).cast("int"))
    segmentations = {"cells": lambda: cells, "eroded": lambda: pixels.erode_labels(cells, 1)}
    return grid_search.infected_cell_grid(image_levels(t), segmentations, nuclei, truth, (True, False), (0, 1), (0.5, 0.9), (0.5, 1.5))


def rounded_scores(grid):
    """Equal means may differ in their last bits, so points are compared by six digits."""

    @grid.step
    def rounded(scores):
        return scores.withColumn("f_score", F.floor(F.col("f_score") * 1e6 + 0.4987) / 1e6)

    return grid


@query("A25_grid_all_axes", f"SELECT segmentation, ignore_nuclei, denoise_radius::BIGINT denoise_radius, quantile, threshold, n_images, {r('f_score', 'f_score')} FROM gs", GRID)
def a25_all(t: Tables):
    return marker_grid(t).table("scores")


@query("A25_grid_best_point", f"SELECT segmentation, ignore_nuclei, denoise_radius::BIGINT denoise_radius, quantile, threshold, n_images, {r('f_score', 'f_score')} FROM gs ORDER BY {six('f_score')} DESC, segmentation, ignore_nuclei, denoise_radius, quantile, threshold LIMIT 1", GRID)
def a25_best(t: Tables):
    return rounded_scores(marker_grid(t)).best("rounded", "f_score")


@query("J16_pred_truth_join", "SELECT plate, count(*) n, count(*) FILTER (WHERE p = tr) same FROM pd WHERE label_id <> 0 AND threshold = 0.55 GROUP BY plate", PREDICTED)
def j16(t: Tables):
    from ..operators import classify
    from ..plans.plate_analysis import marker_background

    pred = classify.classify(t.cells, marker_background(t.cells), ["plate"], threshold=0.55).where("label_id <> 0").select("plate", "image", "label_id", "is_control")
    truth = t.cells.select("image", "label_id", (F.col("tag") != 1).cast("int").alias("truth"))
    return pred.join(truth, ["image", "label_id"]).groupBy("plate").agg(F.count("*").alias("n"), F.count_if(F.col("is_control") == F.col("truth")).alias("same"))


CURVE = """st AS (SELECT score threshold, sum(truth) p, sum(1 - truth) n FROM scored GROUP BY score), cu AS (SELECT threshold, p, n, sum(p) OVER w cp, sum(n) OVER w cn FROM st WINDOW w AS (ORDER BY threshold DESC)),
roc AS (SELECT threshold, cn::DOUBLE / nullif((SELECT sum(n) FROM st), 0) fpr, cp::DOUBLE / nullif((SELECT sum(p) FROM st), 0) tpr FROM cu)"""


@query("W9_roc_curve", f"SELECT threshold, {r('fpr', 'fpr')}, {r('tpr', 'tpr')} FROM roc", CURVE)
def w9(t: Tables):
    return evaluate.roc_curve(t.scored)


@query("W10_auc", f"SELECT {r('sum((fpr - pf) * (tpr + pt) / 2)', 'auc')} FROM (SELECT fpr, tpr, coalesce(lag(fpr) OVER (ORDER BY threshold DESC), 0) pf, coalesce(lag(tpr) OVER (ORDER BY threshold DESC), 0) pt FROM roc)", CURVE)
def w10(t: Tables):
    return evaluate.auc(t.scored)


@query("W11_optimal_threshold", f"SELECT coalesce(nx, threshold) threshold, {r('fpr', 'fpr')}, {r('tpr', 'tpr')} FROM (SELECT *, lead(threshold) OVER (ORDER BY threshold DESC) nx FROM roc) ORDER BY tpr - 2 * fpr DESC, threshold DESC LIMIT 1", CURVE)
def w11(t: Tables):
    return evaluate.best_threshold(evaluate.roc_curve(t.scored), 2.0)


@query("S11_read_score_sheet", "SELECT lang, count(*) n, sum(truth)::BIGINT positives, sum(score)::BIGINT total, max(doc_id) last FROM scored GROUP BY lang")
def s11(t: Tables):
    """A score sheet that an export wrote: every column is text in the file, and typed by what all of its rows hold."""
    path = shared_folder(t.spark)
    sinks.export_flat(t.scored.withColumn("score", F.col("score").cast("long")), path)
    sheet = readers.typed(t.spark.read.option("header", True).csv(path))
    return sheet.groupBy("lang").agg(F.count("*").alias("n"), F.sum("truth").alias("positives"), F.sum("score").alias("total"), F.max("doc_id").alias("last"))


def forest_cells(t: Tables):
    return t.classified.where("label_id <> 0").select("plate", "image", "label_id", "sizes", "means", "marker", "second", "is_outlier", F.when(F.col("tag") == 1, 1.0).otherwise(0.0).alias("truth"))


FEATURES = ["sizes", "means", "marker", "second"]


@query("X1_rf_cells")
def x1(t: Tables):
    cells = forest_cells(t)
    model = learn.train_forest(cells, FEATURES, "truth")
    return model.transform(cells).select("image", "label_id", F.col("prediction").cast("long").alias("prediction"))


@query("X1_rf_folds", "SELECT plate % 3 fold, count(*) n, count(*) FILTER (WHERE tag = 1) positives, count(DISTINCT plate) plates FROM cells WHERE label_id <> 0 GROUP BY 1")
def x1_folds(t: Tables):
    """Each plate's cells by a forest that hasn't seen it; what the confusion counts must add up to, whatever is predicted."""
    cells = forest_cells(t)
    predicted = learn.held_out_forest(cells, FEATURES, "truth", F.pmod("plate", F.lit(3)).cast("int"), 3, trees=30, depth=6)
    plates = predicted.groupBy("fold").agg(F.countDistinct("plate").alias("plates"))
    return learn.fold_confusion(predicted, "truth").join(plates, "fold").select("fold", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"), (F.col("tp") + F.col("fn")).alias("positives"), "plates")
