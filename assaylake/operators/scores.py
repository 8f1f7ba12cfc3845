"""Two-group scores: infected against control cells of an image or a well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.stats import QUANTILES


def group_statistics(cells: DataFrame, keys: list[str], values: tuple[str, ...] = ("sums", "means")) -> DataFrame:
    """keys, is_infected, n_pixels, pixel_sum, pixel_mean, and for each value its quantiles, MAD and mean.

    All quantiles of a value come from one buffer of its distinct values. A MAD needs the median first, so it is a second
    aggregate of the same partitioning."""
    own = Window.partitionBy(*keys, "is_infected")
    kept = cells.where("is_infected = 1 or is_control = 1").withColumns({f"_m_{v}": F.median(v).over(own) for v in values})
    aggs = [F.sum("sizes").alias("n_pixels"), F.sum("sums").alias("pixel_sum"), F.try_divide(F.sum("sums"), F.sum("sizes")).alias("pixel_mean")]
    for v in values:
        aggs += [F.percentile(v, QUANTILES).alias(f"_q_{v}"), F.median(F.abs(F.col(v) - F.col(f"_m_{v}"))).alias(f"mad_of_{v}"), F.avg(v).alias(f"mean_of_{v}")]
    out = kept.groupBy(*keys, "is_infected").agg(*aggs)
    columns = [F.col(c) for c in (*keys, "is_infected", "n_pixels", "pixel_sum", "pixel_mean")]
    for v in values:
        columns += [F.get(f"_q_{v}", k).alias(f"q{q}_of_{v}") for k, q in enumerate(QUANTILES)] + [F.col(f"mad_of_{v}"), F.col(f"mean_of_{v}")]
    return out.select(*columns)


#: What is compared: the name, and the quantile of the infected and the control group. The ratio of unlike quantiles
#: takes them the other way round, as fixed by the assay.
PAIRS = (("mean", "mean", "mean"), ("q0.5", "q0.5", "q0.5"), ("q0.7_vs_q0.3", "q0.7", "q0.3"), ("q0.3_vs_q0.7", "q0.3", "q0.7"))


def _centred(cells: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``cells`` with the control group's median, over the partitioning that the aggregate then uses."""
    return cells.withColumn("_m", F.median(F.when(F.col("is_control") == 1, F.col(value))).over(Window.partitionBy(*keys)))


#: Quantiles that the pairs take, in one buffer a group.
TAKEN = (0.3, 0.5, 0.7)


def _group_aggregates(value: str) -> list[Column]:
    ctl, inf = F.when(F.col("is_control") == 1, F.col(value)), F.when(F.col("is_infected") == 1, F.col(value))
    return [F.avg(inf).alias("i_mean"), F.avg(ctl).alias("c_mean"), F.median(F.abs(ctl - F.col("_m"))).alias("c_mad"), F.percentile(inf, TAKEN).alias("_i"), F.percentile(ctl, TAKEN).alias("_c")]


def _score_columns() -> list[Column]:
    get = lambda side, key: F.get(f"_{side}", TAKEN.index(float(key[1:]))) if key[0] == "q" else F.col(f"{side}_{key}")
    out: list[Column] = []
    for name, one, two in PAIRS:
        a, b = get("i", one), get("c", two)
        out += [F.try_divide(get("i", two), get("c", one)).alias(f"ratio_of_{name}"), (a - b).alias(f"diff_of_{name}"), F.try_divide(a - b, a + b).alias(f"dos_of_{name}")]
    return [*out, F.try_divide(get("i", "q0.5") - get("c", "q0.5"), F.col("c_mad")).alias("robust_z_score")]


COUNTS = ("n_infected", "n_control", "n_cells", "fraction_infected", "infected_mean_size", "infected_median_size", "control_mean_size", "control_median_size", "n_outlier_cells")


def _count_aggregates(outliers: str) -> list[Column]:
    inf, ctl = F.col("is_infected") == 1, F.col("is_control") == 1
    total, size = F.count_if(inf) + F.count_if(ctl), F.col("sizes")
    values = (F.count_if(inf), F.count_if(ctl), total, F.try_divide(F.count_if(inf), total), F.avg(F.when(inf, size)), F.median(F.when(inf, size)), F.avg(F.when(ctl, size)), F.median(F.when(ctl, size)), F.count_if(F.col(outliers) == 1))
    return [v.alias(n) for v, n in zip(values, COUNTS)]


def two_group_scores(cells: DataFrame, keys: list[str], value: str = "means") -> DataFrame:
    """keys, and ratio_of_, diff_of_, dos_of_ each pair, and robust_z_score. Groups side by side in one aggregate;
    null where a group is empty or a denominator is 0."""
    return _centred(cells, keys, value).groupBy(*keys).agg(*_group_aggregates(value)).select(*keys, *_score_columns())


def counts(cells: DataFrame, keys: list[str], outliers: str = "is_outlier") -> DataFrame:
    """Numbers and sizes of the groups, and of outlier cells."""
    return cells.groupBy(*keys).agg(*_count_aggregates(outliers))


def scores_and_counts(cells: DataFrame, keys: list[str], value: str, outliers: str = "is_outlier") -> DataFrame:
    """Both in one aggregate."""
    return _centred(cells, keys, value).groupBy(*keys).agg(*_group_aggregates(value), *_count_aggregates(outliers)).select(*keys, *_score_columns(), *COUNTS)


def _flagged(table: DataFrame, image_flags: DataFrame) -> DataFrame:
    flags = image_flags.select("image", "is_outlier", "outlier_type")
    return table.join(flags, "image", "left").withColumn("is_outlier", F.coalesce("is_outlier", F.lit(-1))).withColumn("outlier_type", F.coalesce("outlier_type", F.lit("not_checked")))


def image_table(cells: DataFrame, image_flags: DataFrame, value: str = "means") -> DataFrame:
    """Scores, counts and flags of each image; the score is null for an outlier."""
    table = scores_and_counts(cells, ["plate", "well", "image"], value)
    return _flagged(table, image_flags).withColumn("score", F.when(F.col("is_outlier") != 1, F.col("`ratio_of_q0.5`")))


def _well_rows(cells: DataFrame, bad: DataFrame) -> DataFrame:
    """plate, well, n_outlier_images, n_images, is_outlier, outlier_type of every well that has cells."""
    wells = cells.select("plate", "well", "image").distinct().join(bad.withColumn("_bad", F.lit(1)), "image", "left").groupBy("plate", "well").agg(F.count("_bad").alias("n_outlier_images"), F.count("*").alias("n_images"))
    none = F.col("n_outlier_images") == F.col("n_images")
    return wells.withColumn("is_outlier", F.when(none, 1).otherwise(0)).withColumn("outlier_type", F.when(none, "all images are outliers").otherwise("none"))


def well_table(cells: DataFrame, image_flags: DataFrame, value: str = "means") -> DataFrame:
    """The same over all cells of a well's images that are not outliers; a well of outlier images alone has nulls and is
    an outlier itself."""
    keys, bad = ["plate", "well"], image_flags.where("is_outlier = 1").select("image")
    table = scores_and_counts(cells.join(bad, "image", "left_anti"), keys, value)
    return _well_rows(cells, bad).join(table, keys, "left").withColumn("score", F.col("`ratio_of_q0.5`"))


#: Statistics of a group that stand beside the scores.
STATISTICS = tuple(f"q{q}" for q in QUANTILES) + ("mad", "mean")


def all_scores(cells: DataFrame, keys: list[str], values: tuple[str, ...] = ("sums", "means"), beside: Sequence[Column] = ()) -> DataFrame:
    """keys, and for each value ratio_of_, diff_of_, dos_of_ and pvalue_of_ each pair, robust_z_score_, and infected_ and
    control_ quantiles, MAD and mean; null where a group is empty or a denominator is 0. ``beside`` are further
    aggregates of the same groups, so that all of a table comes from one.

    The p-value of all pairs of a value is that of Welch's test of the groups' cells by it."""
    groups = (("i", "is_infected", "infected"), ("c", "is_control", "control"))
    of = lambda flag, v: F.when(F.col(flag) == 1, F.col(v))
    aggs: list[Column] = [*beside]
    for v in values:
        aggs += stats.welch_terms(of("is_infected", v), of("is_control", v), f"_{v}_")
        for g, flag, _ in groups:
            aggs += [F.sort_array(F.collect_list(of(flag, v).cast("double"))).alias(f"_{g}s_{v}"), F.avg(of(flag, v)).alias(f"_{g}mean_{v}")]
    # quantiles and MAD are read from a group's sorted values: one buffer of each group instead of a window and three
    table = cells.groupBy(*keys).agg(*aggs)
    for g, v in [(g, v) for v in values for g, _, _ in groups]:
        own = F.col(f"_{g}s_{v}")
        median = stats.quantile_of_sorted(own, 0.5)
        table = table.withColumns({f"_{g}q_{v}": F.array(*(stats.quantile_of_sorted(own, q) for q in QUANTILES)), "_median": median})
        table = table.withColumn("_gaps", F.sort_array(F.transform(own, lambda x: F.abs(x - F.col("_median")))))
        table = table.withColumn(f"_{g}mad_{v}", stats.quantile_of_sorted(F.col("_gaps"), 0.5)).drop("_gaps", "_median", f"_{g}s_{v}")
    out: list[Column] = [F.col(c) for c in table.columns if c not in keys and not c.startswith("_")]
    for v in values:
        t, dof = stats.welch_of(f"_{v}_")
        get = lambda g, key, v=v: F.get(f"_{g}q_{v}", QUANTILES.index(float(key[1:]))) if key[0] == "q" else F.col(f"_{g}{key}_{v}")
        table = table.withColumn(f"_p_{v}", stats.t_test_p(t, dof))
        for name, one, two in PAIRS:
            a, b = get("i", one), get("c", two)
            out += [F.try_divide(get("i", two), get("c", one)).alias(f"ratio_of_{name}_of_{v}"), F.try_divide(a - b, a + b).alias(f"dos_of_{name}_of_{v}"), (a - b).alias(f"diff_of_{name}_of_{v}"), F.col(f"_p_{v}").alias(f"pvalue_of_{name}_of_{v}")]
        out.append(F.try_divide(get("i", "q0.5") - get("c", "q0.5"), get("c", "mad")).alias(f"robust_z_score_{v}"))
        out += [get(g, k).alias(f"{name}_{k}_of_cell_{v}") for g, _, name in groups for k in STATISTICS]
    return table.select(*keys, *out)


def full_image_table(cells: DataFrame, image_flags: DataFrame, value: str = "means") -> DataFrame:
    """``image_table`` with all scores, p-values and group statistics of sums and means, in one aggregate of the cells."""
    table = all_scores(cells, ["plate", "well", "image"], beside=_count_aggregates("is_outlier"))
    return _flagged(table, image_flags).withColumn("score", F.when(F.col("is_outlier") != 1, F.col(f"`ratio_of_q0.5_of_{value}`")))


def full_well_table(cells: DataFrame, image_flags: DataFrame, value: str = "means") -> DataFrame:
    """``well_table`` with all scores, p-values and group statistics of sums and means, of the images that are no outliers."""
    keys, bad = ["plate", "well"], image_flags.where("is_outlier = 1").select("image")
    table = all_scores(cells.join(bad, "image", "left_anti"), keys, beside=_count_aggregates("is_outlier"))
    return _well_rows(cells, bad).join(table, keys, "left").withColumn("score", F.col(f"`ratio_of_q0.5_of_{value}`"))


def pixel_tests(pixels: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    """keys, n_infected, n_control, and of the values under the two masks: ks and ks_p, t and welch_p, z and ranksum_p, each null
    unless both masks have more than ``least`` pixels."""
    masked = pixels.where("mask in (1, 2)").withColumn("_g", F.when(F.col("mask") == 1, 1).otherwise(0))
    n = masked.groupBy(*keys).agg(F.count_if(F.col("_g") == 1).alias("n_infected"), F.count_if(F.col("_g") == 0).alias("n_control"))
    enough = n.where((F.col("n_infected") > least) & (F.col("n_control") > least))
    tested = masked.join(enough.select(*keys), keys, "left_semi")
    out = n.join(stats.ks(tested, keys, "v", "_g"), keys, "left").join(stats.welch(tested, keys, "v", "_g"), keys, "left").join(stats.ranksum(tested, keys, "v", "_g"), keys, "left")
    p = [stats.ks_test_p(F.col("ks"), F.col("n_infected").cast("double"), F.col("n_control").cast("double")).alias("ks_p"), stats.t_test_p("t", "dof").alias("welch_p"), stats.rank_test_p("z").alias("ranksum_p")]
    return out.select(*keys, "n_infected", "n_control", "ks", p[0], "t", p[1], "z", p[2])


def pixel_analysis(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Mean serum under the infected and the control mask and outside both, ratio and difference over sum with and
    without the background; 0 where the denominator is 0."""
    part = lambda c: F.avg(F.when(c, F.col("v")))
    t = pixels.groupBy(*keys).agg(part(F.col("mask") == 1).alias("a"), part(F.col("mask") == 2).alias("b"), part(F.col("mask") == 0).alias("bg"))
    over = lambda n, d: F.when(d != 0, n / F.nullif(d, F.lit(0.0))).otherwise(0.0)
    a, b, bg = F.col("a"), F.col("b"), F.col("bg")
    return t.select(*keys, a.alias("infected_mean"), b.alias("control_mean"), bg.alias("background_mean"), over(a, b).alias("ratio"), over(a - b, a + b).alias("dos"), over(a - bg, b - bg).alias("ratio_wo_bg"), over(a - b, a + b - 2 * bg).alias("dos_wo_bg"))
