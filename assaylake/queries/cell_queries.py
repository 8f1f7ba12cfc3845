"""Cells, backgrounds, classes, quality control and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats
from ..operators import background, classify, evaluate, features, levels, merge, qc, reports, scores
from ..plans import plate_analysis
from ..sources import sinks
from .registry import SMALL, Tables, query, r, student_sql

BOTH = "(is_infected = 1 OR is_control = 1)"
#: Quantiles, counts and scores of two groups in SQL, by the group columns.
TWO = {f"{s}_{k}": f"quantile_cont(means, {q}) FILTER (WHERE {c} = 1)" for s, c in (("i", "is_infected"), ("c", "is_control")) for k, q in (("q3", 0.3), ("q5", 0.5), ("q7", 0.7))}


def two_group_sql(keys: str, source: str) -> tuple[str, str]:
    """(CTE two, columns) that score the groups of ``source``."""
    inner = ", ".join(f"{v} {k}" for k, v in TWO.items())
    cte = f"two AS (SELECT {keys}, avg(means) FILTER (WHERE is_infected = 1) i_mean, avg(means) FILTER (WHERE is_control = 1) c_mean, mad(means) FILTER (WHERE is_control = 1) c_mad, {inner} FROM {source} GROUP BY {keys})"
    out = []
    for name, one, two in (("mean", "mean", "mean"), ("q0_5", "q5", "q5"), ("q0_7_vs_q0_3", "q7", "q3"), ("q0_3_vs_q0_7", "q3", "q7")):
        out += [r(f"i_{two} / nullif(c_{one}, 0)", f"ratio_of_{name}"), r(f"i_{one} - c_{two}", f"diff_of_{name}"), r(f"(i_{one} - c_{two}) / nullif(i_{one} + c_{two}, 0)", f"dos_of_{name}")]
    return cte, ", ".join([*out, r("(i_q5 - c_q5) / nullif(c_mad, 0)", "robust_z_score")])


COUNTS = ", ".join([
    "count(*) FILTER (WHERE is_infected = 1) n_infected", "count(*) FILTER (WHERE is_control = 1) n_control", f"count(*) FILTER (WHERE {BOTH}) n_cells",
    r(f"count(*) FILTER (WHERE is_infected = 1)::DOUBLE / nullif(count(*) FILTER (WHERE {BOTH}), 0)", "fraction_infected"),
    r("avg(sizes) FILTER (WHERE is_infected = 1)", "infected_mean_size"), r("median(sizes) FILTER (WHERE is_infected = 1)", "infected_median_size"),
    r("avg(sizes) FILTER (WHERE is_control = 1)", "control_mean_size"), r("median(sizes) FILTER (WHERE is_control = 1)", "control_median_size"),
    "count(*) FILTER (WHERE is_outlier = 1) n_outlier_cells",
])


@query("A1_cell_features", f"SELECT image, channel, label_id::BIGINT label_id, {r('sum(v)', 'sums')}, {r('avg(v)', 'means')}, count(*) sizes FROM pixels GROUP BY ALL")
def a1(t: Tables):
    return features.cell_features(t.pixels)


@query("A2_cell_median_mad", f"SELECT p.image, p.channel, p.label_id::BIGINT label_id, {r('any_value(m)', 'medians')}, {r('quantile_disc(abs(v - m), 0.5)', 'mads')} FROM pixels p JOIN mm USING (image, channel, label_id) GROUP BY ALL", "mm AS (SELECT image, channel, label_id, quantile_disc(v, 0.5) m FROM pixels GROUP BY ALL)")
def a2(t: Tables):
    return features.cell_median_mad(t.pixels)


@query("A3_cell_quantile", f"SELECT image, channel, label_id::BIGINT label_id, {r('quantile_cont(v, 0.1)', 'quantile0_1')}, {r('quantile_cont(v, 0.9)', 'quantile0_9')} FROM pixels GROUP BY ALL")
def a3(t: Tables):
    return features.cell_quantiles(t.pixels, [0.1, 0.9])


@query("A4_cell_topk", f"SELECT plate, image, {r('coalesce(list_sort(list(sums), ' + chr(39) + 'DESC' + chr(39) + ')[5], 0)', 'top5')} FROM cells GROUP BY ALL")
def a4(t: Tables):
    rows = t.cells.select("image", F.col("plate").alias("channel"), F.lit(0).alias("label_id"), F.col("sums").alias("v"))
    return features.cell_topk(rows, 5).select(F.col("channel").alias("plate"), "image", "top5")


@query("A5_region_props", f"""SELECT image, label_id::BIGINT label_id, {r('avg(y)', 'anchor_y')}, {r('avg(x)', 'anchor_x')}, min(y)::BIGINT bb_min_y, min(x)::BIGINT bb_min_x, (max(y) + 1)::BIGINT bb_max_y, (max(x) + 1)::BIGINT bb_max_x, count(*) size
FROM pixels WHERE label_id <> 0 GROUP BY ALL UNION ALL SELECT DISTINCT image, 0::BIGINT, NULL::DOUBLE, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM pixels""")
def a5(t: Tables):
    return features.region_props(t.pixels)


LEVEL = "SELECT '{name}' \"level\", {plate}, {well}, {image}, channel, {m}, {d} FROM pixels {where} GROUP BY {keys}, channel"


def level_sql(name: str, keys: str, where: str) -> str:
    has = lambda k: k if k in keys else f"NULL::BIGINT {k}"
    return LEVEL.format(name=name, plate=has("plate"), well=has("well"), image=has("image"), m=r("median(v)", "median"), d=r("mad(v)", "mad"), where=where, keys=keys)


FINE = "JOIN pixel_flags USING (image) WHERE label_id = 0 AND is_outlier = 0"


@query("A6_bg_levels", " UNION ALL ".join([level_sql("image", "plate, well, image", "WHERE label_id = 0"), level_sql("well", "plate, well", FINE), level_sql("plate", "plate", FINE)]))
def a6(t: Tables):
    return background.background_levels(t.pixels, t.pixel_flags)


@query("A7_bg_fraction", f"""SELECT 'image' "level", plate, well, image, {r('f', 'fraction')} FROM fi UNION ALL SELECT 'well', plate, well, NULL, (floor((f)::DOUBLE * 1e6 + 0.4987) / 1e6) FROM fw
UNION ALL SELECT 'plate', plate, NULL, NULL, (floor((avg(f))::DOUBLE * 1e6 + 0.4987) / 1e6) FROM fw GROUP BY plate""", "fi AS (SELECT plate, well, image, avg((label_id = 0 AND (image + y * x) % 3 > 0)::INT::DOUBLE) f FROM pixels GROUP BY ALL), fw AS (SELECT plate, well, avg(f) f FROM fi JOIN pixel_flags USING (image) WHERE is_outlier = 0 GROUP BY ALL)")
def a7(t: Tables):
    # part of the quadrant is relabelled, so that fractions differ
    own = t.pixels.withColumn("label_id", F.when((F.col("label_id") == 0) & ((F.col("image") + F.col("y") * F.col("x")) % 3 > 0), 0).otherwise(9))
    return background.background_fraction(own, t.pixel_flags)


@query("A8_bg_from_wells", f"SELECT plate, channel, {r('median(v)', 'median')}, {r('mad(v)', 'mad')} FROM pixels WHERE well IN (1, 2) GROUP BY ALL")
def a8(t: Tables):
    return background.from_wells(t.pixels, t.pixels.where("well in (1, 2)").select("plate", "well").distinct())


@query("A9_mad", f"SELECT plate, {r('median(sums)', 'median')}, {r('mad(sums)', 'mad')} FROM cells GROUP BY plate")
def a9(t: Tables):
    return stats.mad_of_counts(t.cells, ["plate"], "sums")


@query("A10_group_statistics", f"SELECT plate, well, is_infected::BIGINT is_infected, {r('sum(sizes)', 'n_pixels')}, {r('sum(sums)', 'pixel_sum')}, {r('sum(sums) / nullif(sum(sizes), 0)', 'pixel_mean')}, " + ", ".join(x for v in ("sums", "means") for x in [*[r(f"quantile_cont({v}, {q})", f"q0_{int(q * 10)}_of_{v}") for q in stats.QUANTILES], r(f"mad({v})", f"mad_of_{v}"), r(f"avg({v})", f"mean_of_{v}")]) + f" FROM classified WHERE {BOTH} GROUP BY plate, well, is_infected")
def a10(t: Tables):
    return scores.group_statistics(t.classified, ["plate", "well"])


WELL_TWO, WELL_COLUMNS = two_group_sql("plate, well", "classified")


@query("A11_two_group_scores", f"SELECT plate, well, {WELL_COLUMNS} FROM two", WELL_TWO)
def a11(t: Tables):
    return scores.two_group_scores(t.classified, ["plate", "well"])


@query("A12_robust_z", f"SELECT plate, well, {r('(i_q5 - c_q5) / nullif(c_mad, 0)', 'robust_z_score')}, {r('i_q5 / nullif(c_q5, 0)', 'ratio')} FROM two", WELL_TWO)
def a12(t: Tables):
    return robust_z(t)


def robust_z(t: Tables):
    """The flagship: plate background, classes, two groups of each well, z and ratio."""
    return scores.two_group_scores(t.classified, ["plate", "well"]).select("plate", "well", "robust_z_score", F.col("`ratio_of_q0.5`").alias("ratio"))


WELCH = """w AS (SELECT plate, avg(means) FILTER (WHERE is_infected = 1) m1, avg(means) FILTER (WHERE is_control = 1) m0, var_samp(means) FILTER (WHERE is_infected = 1) v1, var_samp(means) FILTER (WHERE is_control = 1) v0,
count(*) FILTER (WHERE is_infected = 1) n1, count(*) FILTER (WHERE is_control = 1) n0 FROM classified GROUP BY plate)"""


@query("A13_welch_ttest", f"SELECT plate, {r('(m1 - m0) / sqrt(v1 / n1 + v0 / n0)', 't')}, {r('(v1 / n1 + v0 / n0) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v0 / n0) ** 2 / (n0 - 1))', 'dof')} FROM w WHERE n1 >= 2 AND n0 >= 2", WELCH)
def a13(t: Tables):
    return stats.welch(t.classified.where("is_infected = 1 or is_control = 1"), ["plate"], "means", "is_infected")


@query("A13_welch_p_value", f"SELECT plate, {r('t', 't')}, {r('dof', 'dof')}, {r(student_sql('t', 'dof'), 'p')} FROM (SELECT plate, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) t, (v1 / n1 + v0 / n0) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v0 / n0) ** 2 / (n0 - 1)) dof FROM w WHERE n1 >= 2 AND n0 >= 2)", WELCH)
def a13_p(t: Tables):
    return a13(t).withColumn("p", stats.t_test_p("t", "dof"))


@query("A14_counts", f"SELECT plate, well, {COUNTS} FROM classified GROUP BY plate, well")
def a14(t: Tables):
    return scores.counts(t.classified, ["plate", "well"])


IMAGE_TWO, IMAGE_COLUMNS = two_group_sql("plate, well, image", "classified")


@query("A15_image_table", f"""SELECT two.plate, two.well, two.image, {IMAGE_COLUMNS}, n.* EXCLUDE (plate, well, image), coalesce(f.is_outlier, -1)::BIGINT is_outlier, coalesce(f.outlier_type, 'not_checked') outlier_type,
CASE WHEN coalesce(f.is_outlier, -1) <> 1 THEN (floor((i_q5 / nullif(c_q5, 0))::DOUBLE * 1e6 + 0.4987) / 1e6) END score FROM two JOIN n USING (plate, well, image) LEFT JOIN flags f USING (image)""", f"{IMAGE_TWO}, n AS (SELECT plate, well, image, {COUNTS} FROM classified GROUP BY plate, well, image)")
def a15(t: Tables):
    return scores.image_table(t.classified, t.flags)


KEPT_TWO, KEPT_COLUMNS = two_group_sql("plate, well", "kept")


@query("A17_well_table", f"""SELECT u.plate, u.well, n_outlier_images, n_images, {KEPT_COLUMNS}, n.* EXCLUDE (plate, well), (n_outlier_images = n_images)::INT::BIGINT is_outlier,
CASE WHEN n_outlier_images = n_images THEN 'all images are outliers' ELSE 'none' END outlier_type, (floor((i_q5 / nullif(c_q5, 0))::DOUBLE * 1e6 + 0.4987) / 1e6) score FROM u LEFT JOIN two USING (plate, well) LEFT JOIN n USING (plate, well)""", f"""kept AS (SELECT * FROM classified WHERE image NOT IN (SELECT image FROM flags WHERE is_outlier = 1)), {KEPT_TWO}, n AS (SELECT plate, well, {COUNTS} FROM kept GROUP BY plate, well),
u AS (SELECT plate, well, count(*) FILTER (WHERE is_outlier = 1) n_outlier_images, count(*) n_images FROM (SELECT DISTINCT plate, well, image FROM cells) JOIN flags USING (image) GROUP BY plate, well)""")
def a17(t: Tables):
    return scores.well_table(t.classified, t.flags)


def all_scores_sql(keys: str, source: str) -> tuple[str, str]:
    """(CTEs, columns) of all scores, p-values and statistics of the groups of ``source``."""
    groups, values = (("i", "is_infected", "infected"), ("c", "is_control", "control")), ("sums", "means")
    inner = [f"{f} {g}{k}_{v}" for v in values for g, c, _ in groups for k, f in (
        *((f"q{q}".replace(".", "_"), f"quantile_cont({v}, {q}) FILTER (WHERE {c} = 1)") for q in stats.QUANTILES), ("mad", f"mad({v}) FILTER (WHERE {c} = 1)"), ("mean", f"avg({v}) FILTER (WHERE {c} = 1)"),
        ("var", f"var_samp({v}) FILTER (WHERE {c} = 1)"), ("n", f"count({v}) FILTER (WHERE {c} = 1)"))]
    tests = []
    for v in values:
        a, b = f"ivar_{v} / in_{v}", f"cvar_{v} / cn_{v}"
        enough = f"in_{v} >= 2 AND cn_{v} >= 2 AND {a} + {b} > 0"
        tests += [f"CASE WHEN {enough} THEN (imean_{v} - cmean_{v}) / sqrt({a} + {b}) END t_{v}", f"CASE WHEN {enough} THEN ({a} + {b}) ** 2 / (({a}) ** 2 / (in_{v} - 1) + ({b}) ** 2 / (cn_{v} - 1)) END dof_{v}"]
    ctes = f"al0 AS (SELECT {keys}, {', '.join(inner)} FROM {source} GROUP BY {keys}), al AS (SELECT *, {', '.join(tests)} FROM al0)"
    out = []
    for v in values:
        for name, one, two in (("mean", "mean", "mean"), ("q0_5", "q0_5", "q0_5"), ("q0_7_vs_q0_3", "q0_7", "q0_3"), ("q0_3_vs_q0_7", "q0_3", "q0_7")):
            i1, i2, c1, c2 = f"i{one}_{v}", f"i{two}_{v}", f"c{one}_{v}", f"c{two}_{v}"
            out += [r(f"{i2} / nullif({c1}, 0)", f"ratio_of_{name}_of_{v}"), r(f"({i1} - {c2}) / nullif({i1} + {c2}, 0)", f"dos_of_{name}_of_{v}"), r(f"{i1} - {c2}", f"diff_of_{name}_of_{v}"), r(f"CASE WHEN t_{v} = 0 THEN 1 ELSE {student_sql(f't_{v}', f'dof_{v}')} END", f"pvalue_of_{name}_of_{v}")]
        out.append(r(f"(iq0_5_{v} - cq0_5_{v}) / nullif(cmad_{v}, 0)", f"robust_z_score_{v}"))
        out += [r(f"{g}{k}_{v}", f"{name}_{k}_of_cell_{v}") for g, _, name in groups for k in (*(f"q{q}".replace(".", "_") for q in stats.QUANTILES), "mad", "mean")]
    return ctes, ", ".join(out)


ALL_WELLS, ALL_COLUMNS = all_scores_sql("plate, well", "classified")
ALL_KEPT, _ = all_scores_sql("plate, well", "kept")
ALL_IMAGES, _ = all_scores_sql("plate, well, image", "classified")


@query("A11_all_scores", f"SELECT plate, well, {ALL_COLUMNS} FROM al", ALL_WELLS)
def a11_all(t: Tables):
    return scores.all_scores(t.classified, ["plate", "well"])


@query("A15_image_table_full", f"""SELECT al.plate, al.well, al.image, {ALL_COLUMNS}, n.* EXCLUDE (plate, well, image), coalesce(f.is_outlier, -1)::BIGINT is_outlier, coalesce(f.outlier_type, 'not_checked') outlier_type,
CASE WHEN coalesce(f.is_outlier, -1) <> 1 THEN (floor((iq0_5_means / nullif(cq0_5_means, 0))::DOUBLE * 1e6 + 0.4987) / 1e6) END score FROM al JOIN n USING (plate, well, image) LEFT JOIN flags f USING (image)""", f"{ALL_IMAGES}, n AS (SELECT plate, well, image, {COUNTS} FROM classified GROUP BY plate, well, image)")
def a15_full(t: Tables):
    return scores.full_image_table(t.classified, t.flags)


@query("A17_well_table_full", f"""SELECT u.plate, u.well, n_outlier_images, n_images, {ALL_COLUMNS}, n.* EXCLUDE (plate, well), (n_outlier_images = n_images)::INT::BIGINT is_outlier,
CASE WHEN n_outlier_images = n_images THEN 'all images are outliers' ELSE 'none' END outlier_type, (floor((iq0_5_means / nullif(cq0_5_means, 0))::DOUBLE * 1e6 + 0.4987) / 1e6) score FROM u LEFT JOIN al USING (plate, well) LEFT JOIN n USING (plate, well)""", f"""kept AS (SELECT * FROM classified WHERE image NOT IN (SELECT image FROM flags WHERE is_outlier = 1)), {ALL_KEPT}, n AS (SELECT plate, well, {COUNTS} FROM kept GROUP BY plate, well),
u AS (SELECT plate, well, count(*) FILTER (WHERE is_outlier = 1) n_outlier_images, count(*) n_images FROM (SELECT DISTINCT plate, well, image FROM cells) JOIN flags USING (image) GROUP BY plate, well)""")
def a17_full(t: Tables):
    return scores.full_well_table(t.classified, t.flags)


@query("A45_well_stats_multi", f"SELECT plate, well, {r('quantile_cont(means, 0.5)', 'median')}, {r('avg(means)', 'mean')}, count(*) n FROM classified WHERE is_control = 1 GROUP BY plate, well")
def a45(t: Tables):
    return t.classified.where("is_control = 1").groupBy("plate", "well").agg(F.percentile("means", 0.5).alias("median"), F.avg("means").alias("mean"), F.count("*").alias("n"))


@query("A18_image_outlier", "SELECT image, is_outlier::BIGINT is_outlier, outlier_type FROM flags")
def a18(t: Tables):
    return t.flags


WELLS = f"wl AS (SELECT plate, well, count(*) FILTER (WHERE is_control = 1) n_control, count(*) FILTER (WHERE is_infected = 1) n_infected, avg(means) FILTER (WHERE is_infected = 1) infected_mean FROM classified GROUP BY plate, well), fl AS (SELECT plate, mad(means) * 3 f FROM cells WHERE label_id = 0 GROUP BY plate)"


@query("A19_well_outlier", """SELECT plate, well, (why <> '')::INT::BIGINT is_outlier, CASE WHEN why = '' THEN 'none' ELSE why END outlier_type FROM (SELECT plate, well, concat_ws(';', CASE WHEN n_control < 15 THEN 'too few control cells' END,
CASE WHEN n_infected < 5 THEN 'too few infected cells' END, CASE WHEN infected_mean < f THEN 'too low infected intensity' END) why FROM wl JOIN fl USING (plate))""", WELLS)
def a19(t: Tables):
    inf = F.when(F.col("is_infected") == 1, F.col("means"))
    wells = t.classified.groupBy("plate", "well").agg(F.count_if(F.col("is_control") == 1).alias("n_control"), F.count_if(F.col("is_infected") == 1).alias("n_infected"), F.avg(inf).alias("infected_mean"))
    empty = stats.mad(t.cells.where("label_id = 0"), ["plate"], "means").withColumn("channel", F.lit("serum"))
    floor = qc.intensity_floor(empty, preset=300.0).select("plate", "floor")
    return qc.well_outliers(wells.join(floor, "plate"), SMALL.min_control, 5, F.col("floor"))


@query("A20_min_well", f"SELECT plate, 'serum' channel, arg_min(well, (m, well)) min_well, {r('min(m)', 'median')}, {r('arg_min(d, (m, well))', 'mad')} FROM mw WHERE f BETWEEN 0.1 AND 0.3 GROUP BY plate", "mw AS (SELECT plate, well, median(means) FILTER (WHERE label_id = 0) m, mad(means) FILTER (WHERE label_id = 0) d, avg((label_id = 0)::INT::DOUBLE) f FROM cells GROUP BY plate, well)")
def a20(t: Tables):
    wells = stats.mad(t.cells.where("label_id = 0"), ["plate", "well"], "means").join(t.cells.groupBy("plate", "well").agg(F.avg((F.col("label_id") == 0).cast("double")).alias("fraction")), ["plate", "well"])
    return background.min_well(wells.withColumn("channel", F.lit("serum")), 0.1, 0.3)


@query("A30_plate_rating", f"SELECT plate, {r('avg(nullif(well % 5, 0))', 'mean_rating')}, count(*) n_images FROM images GROUP BY plate")
def a30(t: Tables):
    return qc.plate_ratings(t.images.select("plate", (F.col("well") % 5).alias("rating")))


@query("A31_outlier_rates", f"SELECT plate, count(*) n, {r('avg((is_outlier = 1)::INT)', 'outlier_rate')}, {r('avg((is_outlier = 1 AND NOT contains(outlier_type, ' + chr(39) + 'manual: 1' + chr(39) + '))::INT)', 'heuristic_rate')}, {r('avg(contains(outlier_type, ' + chr(39) + 'manual: 1' + chr(39) + ')::INT)', 'manual_rate')} FROM flags JOIN images USING (image) GROUP BY ROLLUP (plate)")
def a31(t: Tables):
    return qc.outlier_rates(t.flags.join(t.images.select("image", "plate"), "image"))


@query("A33_mean_mad", f"SELECT {r('avg(dev)', 'mean_mad')} FROM bg WHERE plate % 2 = 1 AND plate <> 7")
def a33(t: Tables):
    return plate_analysis.marker_background(t.cells).where("plate % 2 = 1 and plate <> 7").agg(F.avg("mad").alias("mean_mad"))


@query("A34_well_medians", f"SELECT plate, well, {r('median(s)', 'median')}, count(s) n FROM sc GROUP BY plate, well HAVING count(s) >= 3", "sc AS (SELECT plate, well, image, avg(means) FILTER (WHERE is_control = 1) s FROM classified GROUP BY ALL)")
def a34(t: Tables):
    image = t.classified.groupBy("plate", "well", "image").agg(F.avg(F.when(F.col("is_control") == 1, F.col("means"))).alias("s"))
    return image.groupBy("plate", "well").agg(F.median("s").alias("median"), F.count("s").alias("n")).where("n >= 3")


@query("A35_plate_heatmap", "SELECT plate, well % 8 AS \"row\", " + ", ".join(r(f"median(means) FILTER (WHERE well // 8 % 12 = {k})", f"c{k + 1}") for k in range(12)) + " FROM cells GROUP BY plate, well % 8")
def a35(t: Tables):
    at = t.cells.withColumn("row", F.col("well") % 8).withColumn("col", F.concat(F.lit("c"), (F.floor(F.col("well") / 8) % 12 + 1).cast("string")))
    return at.groupBy("plate", "row").pivot("col", [f"c{k}" for k in range(1, 13)]).agg(F.median("means"))


@query("A36_score_distribution", f"SELECT *, {r('sum(n) OVER (PARTITION BY truth ORDER BY bin)::DOUBLE / sum(n) OVER (PARTITION BY truth)', 'share')} FROM hb", "hb AS (SELECT truth, CASE WHEN score < 0 THEN 0 WHEN score >= 20000 THEN 41 ELSE floor(score / 500)::BIGINT + 1 END bin, count(*) n FROM scored GROUP BY ALL)")
def a36(t: Tables):
    return evaluate.cumulative_share(evaluate.histogram(t.scored, "score", 0, 20000, 40, ["truth"]), ["truth"])


@query("A37_histogram_by_time", """SELECT bin, count(*) FILTER (WHERE tb = 'days 0-10') d0_10, count(*) FILTER (WHERE tb = 'days 11-14') d11_14, count(*) FILTER (WHERE tb = 'days 15+') d15 FROM
(SELECT CASE WHEN m < 1 THEN 0 WHEN m >= 5 THEN 30 ELSE floor((m - 1) / (4 / 29.0::DOUBLE))::BIGINT + 1 END bin, CASE WHEN days <= 10 THEN 'days 0-10' WHEN days <= 14 THEN 'days 11-14' ELSE 'days 15+' END tb FROM (SELECT sums / 20000 m, well % 30 AS days FROM cells)) GROUP BY bin""")
def a37(t: Tables):
    rows = t.cells.select((F.col("sums") / 20000).alias("m"), evaluate.time_bin(F.col("well") % 30).alias("tb"))
    bins = evaluate.histogram(rows, "m", 1, 5, 29, ["tb"])
    wide = bins.groupBy("bin").pivot("tb", ["days 0-10", "days 11-14", "days 15+"]).agg(F.sum("n")).na.fill(0)
    return wide.toDF("bin", "d0_10", "d11_14", "d15")


@query("A38_dedup_average", f"SELECT image, well, count(score) OVER (PARTITION BY well) n_repeats, CASE WHEN score IS NOT NULL AND row_number() OVER (PARTITION BY well, score IS NULL ORDER BY image) = 1 THEN (floor((avg(score) OVER (PARTITION BY well))::DOUBLE * 1e6 + 0.4987) / 1e6) END price FROM (SELECT image, well, CASE WHEN image % 3 > 0 THEN price END score FROM images)")
def a38(t: Tables):
    measured = t.images.select("image", "well", F.when(F.col("image") % 3 > 0, F.col("price")).alias("price"))
    return evaluate.dedup_average(measured, "well", "price", ["image"])


@query("A40_fp_table", "SELECT priority cohort, count(*) FILTER (WHERE price > 300000) n_over, count(*) n, array_to_string(list_sort(list(image) FILTER (WHERE price > 300000))[1:20], ',') ids FROM images GROUP BY priority")
def a40(t: Tables):
    return evaluate.false_positives(t.images.select(F.col("priority").alias("cohort"), F.col("image").alias("cohort_id"), F.col("price").alias("score")), 300000, ids=20)


@query("A40_fp_ids", "SELECT priority cohort, image cohort_id FROM images WHERE price > 300000")
def a40_ids(t: Tables):
    return evaluate.false_positive_ids(t.images.select(F.col("priority").alias("cohort"), F.col("image").alias("cohort_id"), F.col("price").alias("score")), 300000)


@query("A44_distinct_labels", "SELECT image, label_id::BIGINT label_id, count(*) size FROM cells GROUP BY image, label_id")
def a44(t: Tables):
    return features.distinct_labels(t.cells)


@query("P7_subtract_bg_cell", """SELECT image, label_id::BIGINT label_id, 'sums' stat, (floor((sums - 500 * sizes)::DOUBLE * 1e6 + 0.4987) / 1e6) "value" FROM cells UNION ALL SELECT image, label_id, 'means', (floor((means - 500)::DOUBLE * 1e6 + 0.4987) / 1e6) FROM cells UNION ALL SELECT image, label_id, 'sizes', (floor((sizes)::DOUBLE * 1e6 + 0.4987) / 1e6) FROM cells""")
def p7(t: Tables):
    long = t.cells.withColumn("size", F.col("sizes")).unpivot(["image", "label_id", "size"], ["sums", "means", "sizes"], "stat", "value")
    return long.withColumn("value", background.subtract_from_stat(F.col("stat"), F.col("value"), F.lit(500.0), F.col("size"))).drop("size")


@query("P8_subtract_bg_pixel", f"SELECT image, y::BIGINT y, x::BIGINT x, {r('v - m', 'v')} FROM pixels JOIN (SELECT image, median(v) m FROM pixels WHERE label_id = 0 GROUP BY image) USING (image)")
def p8(t: Tables):
    level = background.background_levels(t.pixels, t.pixel_flags).where("level = 'image'")
    return background.subtract_from_pixels(t.pixels, level).select("image", "y", "x", "v")


@query("P9_classify_infected", "SELECT image, label_id::BIGINT label_id, inf0::BIGINT is_infected, ctl0::BIGINT is_control FROM classed")
def p9(t: Tables):
    return classify.classify(t.cells, plate_analysis.marker_background(t.cells), ["plate"], threshold=SMALL.threshold).select("image", "label_id", "is_infected", "is_control")


@query("P10_classify_grid", "SELECT image, threshold, count(*) FILTER (WHERE label_id <> 0 AND marker > dev * threshold + med) n_infected, count(*) FILTER (WHERE label_id <> 0 AND NOT marker > dev * threshold + med) n_control FROM cells JOIN bg USING (plate), (SELECT unnest([0.05, 0.55, 1.05]::DOUBLE[]) threshold) GROUP BY image, threshold")
def p10(t: Tables):
    grid = classify.classify_grid(t.cells, plate_analysis.marker_background(t.cells), ["plate"], [0.05, 0.55, 1.05])
    return grid.groupBy("image", "threshold").agg(F.count_if(F.col("is_infected") == 1).alias("n_infected"), F.count_if(F.col("is_control") == 1).alias("n_control"))


@query("P11_cell_outlier", "SELECT image, label_id::BIGINT label_id, (sizes > 45 OR sizes < 5)::INT::BIGINT is_outlier, CASE WHEN sizes > 45 THEN 'too_large' WHEN sizes < 5 THEN 'too_small' ELSE 'none' END outlier_type FROM cells")
def p11(t: Tables):
    return qc.cell_outliers(t.cells, 5, 45)


@query("P11_cell_outlier_nuclei", """SELECT image, label_id::BIGINT label_id, (a <> 'none' OR b <> 'none')::INT::BIGINT is_outlier, 'cell:' || a || ',nucleus:' || b outlier_type FROM (SELECT image, label_id, CASE WHEN sizes > 45 THEN 'too_large' WHEN sizes < 5 THEN 'too_small' ELSE 'none' END a,
CASE WHEN label_id % 2 = 0 THEN 'none' WHEN "second" * 100 > 8 THEN 'too_large' WHEN "second" * 100 < 2 THEN 'too_small' ELSE 'none' END b FROM cells)""")
def p11_nuclei(t: Tables):
    nuclei = t.cells.where("label_id % 2 <> 0").select("image", "label_id", (F.col("second") * 100).alias("sizes"))
    return qc.cell_outliers(t.cells, 5, 45, nuclei, (2, 8))


@query("P12_size_mask", "SELECT image, y::BIGINT y, x::BIGINT x, seg::BIGINT label_id FROM s JOIN (SELECT image, seg FROM s WHERE seg <> 0 GROUP BY image, seg HAVING count(*) < 9 OR count(*) > 20) USING (image, seg)", "s AS (SELECT image, y, x, (image * 7 + y * (x // 3)) % 5 seg FROM pixels)")
def p12(t: Tables):
    seg = t.pixels.select("image", "y", "x", ((F.col("image") * 7 + F.col("y") * F.floor(F.col("x") / 3)) % 5).alias("label_id"))
    return qc.size_mask(seg, 9, 20).select("image", "y", "x", "label_id")


@query("P15_outlier_score_null", "SELECT image, is_outlier::BIGINT is_outlier, CASE WHEN is_outlier <> 1 THEN price END score FROM images JOIN flags USING (image)")
def p15(t: Tables):
    return t.images.join(t.flags, "image").select("image", "is_outlier", qc.score_unless_outlier(F.col("price"), F.col("is_outlier")).alias("score"))


@query("P34_filter_cells", f"SELECT image, label_id::BIGINT label_id, {r('means', 'means')} FROM classified WHERE is_infected = 1")
def p34(t: Tables):
    return t.classified.where("is_infected = 1").select("image", "label_id", "means")


@query("J1_lift_plate_to_well", f"SELECT DISTINCT plate, well, {r('med', 'median')}, {r('dev', 'mad')} FROM images JOIN bg USING (plate)")
def j1(t: Tables):
    return levels.lift(plate_analysis.marker_background(t.cells), t.images.select("plate", "well").distinct())


@query("J2_lift_well_to_image", "SELECT plate, well, image, n FROM images JOIN (SELECT plate, well, count(*) n FROM images GROUP BY ALL) USING (plate, well)")
def j2(t: Tables):
    return levels.lift(t.images.groupBy("plate", "well").agg(F.count("*").alias("n")), t.images.select("plate", "well", "image"))


@query("J3_to_image_table", f"SELECT plate, well, image, {r('med', 'median')}, {r('dev', 'mad')} FROM images JOIN bg USING (plate)")
def j3(t: Tables):
    return levels.to_image_table(plate_analysis.marker_background(t.cells), t.images)


@query("J4_bg_lookup", f"SELECT image, 'IgG' channel, {r('med', 'background')} FROM images JOIN bg USING (plate) UNION ALL SELECT image, 'IgA', 120.5 FROM images")
def j4(t: Tables):
    table = levels.to_image_table(plate_analysis.marker_background(t.cells), t.images).select("image", F.lit("IgG").alias("channel"), F.col("median").alias("background"))
    return table.unionByName(t.images.select("image", F.lit("IgA").alias("channel"), F.lit(120.5).alias("background")))


@query("J5_serum_marker_join", f"SELECT image, label_id::BIGINT label_id, {r('means', 'serum')}, marker FROM cells")
def j5(t: Tables):
    serum, marker = t.cells.select("image", "label_id", F.col("means").alias("serum")), t.cells.select("image", "label_id", "marker")
    return serum.join(marker, ["image", "label_id"])


@query("J6_classification_join", "SELECT image, label_id::BIGINT label_id, is_infected::BIGINT is_infected, is_control::BIGINT is_control FROM classified")
def j6(t: Tables):
    own = classify.classify(t.cells, plate_analysis.marker_background(t.cells), ["plate"], threshold=SMALL.threshold)
    return classify.without_outliers(own, qc.cell_outliers(t.cells, 5, 45)).select("image", "label_id", "is_infected", "is_control")


@query("J7_outlier_join", "SELECT i.image, coalesce(f.is_outlier, -1)::BIGINT is_outlier, coalesce(f.outlier_type, 'not_checked') outlier_type FROM images i LEFT JOIN (SELECT * FROM flags WHERE image % 3 = 0) f USING (image)")
def j7(t: Tables):
    return qc.with_flags(t.images.select("image"), t.flags.where("image % 3 = 0"), ["image"])


@query("J8_manual_tag_join", "SELECT i.image, coalesce(tag, -1)::BIGINT tag FROM images i LEFT JOIN tags USING (image)")
def j8(t: Tables):
    return t.images.select("image").join(qc.manual_tags(t.tags), "image", "left").withColumn("tag", F.coalesce("tag", F.lit(-1)))


CHANNELS = f"ch AS (SELECT plate, well, {r('avg(means)', 'mean')}, count(*) n_cells, {r("avg(\"second\")", "mean_a")}, {r('avg(marker)', 'marker_mean')} FROM cells GROUP BY plate, well)"


@query("J9_merge_channel_tables", "SELECT plate, well, mean \"IgG_mean\", n_cells, marker_mean, mean_a \"IgA_mean\" FROM ch", CHANNELS)
def j9(t: Tables):
    own = t.cells.groupBy("plate", "well").agg(F.avg("means").alias("mean"), F.avg("second").alias("mean_a"), F.avg("marker").alias("marker_mean"), F.count("*").alias("n_cells"))
    g, a = own.select("plate", "well", "mean", "n_cells", "marker_mean"), own.select("plate", "well", F.col("mean_a").alias("mean"), "n_cells", "marker_mean")
    return merge.merge_tables({"IgA": a, "IgG": g}, ["plate", "well"], "IgG", ["n_cells"])


@query("J10_merge_mean_sum", f"SELECT plate, well, {r('avg(means)', 'mean')}, {r('sum(sums * 2)', 'sum')} FROM cells GROUP BY plate, well")
def j10(t: Tables):
    own = lambda k: t.cells.groupBy("plate", "well").agg(F.avg(F.col("means") * k).alias("mean"), F.sum(F.col("sums") * k).alias("sum"))
    return merge.means_and_sums(own(1), own(2), ["plate", "well"])


@query("J11_cell_anchor_join", f"SELECT image, label_id::BIGINT label_id, {r('sum(v)', 'sums')}, CASE WHEN label_id <> 0 THEN avg(y) END anchor_y, CASE WHEN label_id <> 0 THEN avg(x) END anchor_x FROM pixels GROUP BY image, label_id")
def j11(t: Tables):
    cells = features.cell_features(t.pixels).select("image", "label_id", "sums")
    return merge.with_properties(cells, features.region_props(t.pixels))


@query("J19_mask_join", f"SELECT image, label_id::BIGINT label_id, {r('sum(v)', 'sums')}, count(*) n FROM pixels WHERE NOT (y % 4 IN (1, 2) AND x % 4 IN (1, 2)) GROUP BY image, label_id")
def j19(t: Tables):
    core = (F.col("y") % 4).isin(1, 2) & (F.col("x") % 4).isin(1, 2)
    nuclei = t.pixels.select("image", "y", "x", F.when(core, F.col("label_id") + 1).otherwise(0).alias("nucleus_id"))
    return features.masked(t.pixels, nuclei).groupBy("image", "label_id").agg(F.sum("v").alias("sums"), F.count("*").alias("n"))


@query("P25_columns_by_pattern", f"SELECT plate, well, {r('quantile_cont(means, 0.5)', 'q0_5_of_means')}, {r('avg(means)', 'mean_of_means')} FROM cells GROUP BY plate, well")
def p25(t: Tables):
    table = t.cells.groupBy("plate", "well").agg(F.percentile("means", 0.5).alias("q0.5_of_means"), F.avg("means").alias("mean_of_means"), F.sum("sums").alias("sums_total"))
    return merge.by_pattern(table, ["_of_means"], ["plate", "well"])


@query("P32_sum_visibility", f"SELECT image, {r('sum(sums)', 'sum_of_sums')}, {r('avg(means)', 'mean')} FROM cells GROUP BY image")
def p32(t: Tables):
    return merge.hidden(t.cells.groupBy("image").agg(F.sum("sums").alias("sum_of_sums"), F.avg("means").alias("mean")))


@query("U1_union_plates", f"SELECT plate, well, {r('avg(means)', 'mean_g')}, NULL::DOUBLE mean_a FROM cells WHERE plate % 2 = 0 GROUP BY ALL UNION ALL SELECT plate, well, NULL, (floor((avg(\"second\"))::DOUBLE * 1e6 + 0.4987) / 1e6) FROM cells WHERE plate % 2 = 1 GROUP BY ALL")
def u1(t: Tables):
    g = t.cells.where("plate % 2 = 0").groupBy("plate", "well").agg(F.avg("means").alias("mean_g"))
    a = t.cells.where("plate % 2 = 1").groupBy("plate", "well").agg(F.avg("second").alias("mean_a"))
    return merge.union_plates([g, a])


@query("U2_concat_cells", "SELECT plate, sum(1 + (marker > 0.03)::INT)::BIGINT n_cells, count(DISTINCT image) n_images FROM cells GROUP BY plate")
def u2(t: Tables):
    """Cells of two channels on top of each other, the second with fewer columns and rows."""
    both = reports.concat_cells([t.cells, t.cells.where("marker > 0.03").select("plate", "image", "label_id", "second")], ["plate", "image", "label_id"])
    return reports.cell_numbers(both, ["plate"])


@query("K3_export_rounded", "SELECT image, round(sums / 3, 2) third, label_id::BIGINT label_id FROM cells")
def k3(t: Tables):
    return merge.rounded(t.cells.select("image", (F.col("sums") / 3).alias("third"), "label_id"))


@query("K4_export_cells", f"SELECT plate, well, image, CASE WHEN label_id <> 0 THEN avg(y) END anchor_y, CASE WHEN label_id <> 0 THEN avg(x) END anchor_x, label_id::BIGINT label_id, {r('avg(v)', 'means')} FROM pixels GROUP BY plate, well, image, label_id")
def k4(t: Tables):
    cells = features.cell_features(t.pixels).join(t.pixels.select("plate", "well", "image").distinct(), "image").select("plate", "well", "image", "label_id", "means")
    return sinks.cell_export(cells, features.region_props(t.pixels))


@query("K8_image_notes", "SELECT image, concat_ws('; ', CASE WHEN is_outlier = 1 THEN outlier_type END, priority) note FROM images JOIN flags USING (image)")
def k8(t: Tables):
    return t.images.join(t.flags, "image").select("image", merge.joined_notes(F.when(F.col("is_outlier") == 1, F.col("outlier_type")), F.col("priority")).alias("note"))


@query("K10_analysis_parameters", "SELECT DISTINCT plate, 0.55::DOUBLE parameter_threshold, 5.0::DOUBLE parameter_smallest_cell, 45.0::DOUBLE parameter_largest_cell, 15::BIGINT parameter_min_control FROM images")
def k10(t: Tables):
    s = {"threshold": SMALL.threshold, "smallest_cell": float(SMALL.smallest_cell), "largest_cell": float(SMALL.largest_cell), "min_control": SMALL.min_control}
    return t.images.select("plate").distinct().select("plate", *[F.lit(v).alias(f"parameter_{k}") for k, v in s.items()])
