"""ROC curves, confusion counts, segmentation overlap and parameter grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import running_sums


def _by_score(scores: DataFrame, score: str, truth: str) -> DataFrame:
    """threshold, p, n, cum_p, cum_n: positives and negatives with each distinct score, and with that or a higher one."""
    judged = scores.where(F.col(score).isNotNull() & F.col(truth).isNotNull()).select(F.col(score).alias("threshold"), F.col(truth).alias("p"), (1 - F.col(truth)).alias("n"))
    return running_sums(judged, "threshold", ["p", "n"], descending=True)


def roc_curve(scores: DataFrame, score: str = "score", truth: str = "truth") -> DataFrame:
    """threshold, fpr, tpr with every distinct score as a threshold, taken by scores at or above it. Equal scores are added up
    before anything is ordered, so a score in half of the rows is one row."""
    summed = _by_score(scores, score, truth)
    total = summed.agg(F.sum("p").alias("P"), F.sum("n").alias("N"))
    p, n = total.select("P").scalar(), total.select("N").scalar()
    return summed.select("threshold", F.try_divide(F.col("cum_n"), n).alias("fpr"), F.try_divide(F.col("cum_p"), p).alias("tpr"))


def auc(scores: DataFrame, score: str = "score", truth: str = "truth") -> DataFrame:
    """One row auc: the trapezoids under the curve, summed by distinct score; no global order of rows is needed but the
    running counts."""
    # each step right by n under the mean height of its ends
    area = F.sum(F.col("n") * (F.col("cum_p") - F.col("p") / 2))
    return _by_score(scores, score, truth).agg(F.try_divide(area, F.sum("p") * F.sum("n")).alias("auc"))


def best_threshold(curve: DataFrame, m: float = 1.0) -> DataFrame:
    """One row threshold, fpr, tpr: the threshold after the one with the greatest tpr - m * fpr (the first of equals); the
    last has none after it and stays."""
    gain = F.col("tpr") - F.lit(float(m)) * F.col("fpr")
    best = curve.agg(F.max_by(F.struct("threshold", "fpr", "tpr"), F.struct(gain, F.col("threshold"))).alias("b"))
    at = best.select(F.col("b.threshold")).scalar()
    after = curve.where(F.col("threshold") < at).agg(F.max("threshold").alias("t"))
    return best.select(F.coalesce(after.select("t").scalar(), F.col("b.threshold")).alias("threshold"), F.col("b.fpr").alias("fpr"), F.col("b.tpr").alias("tpr"))


def confusion(pred: DataFrame, keys: list[str]) -> DataFrame:
    """``confusion_of_counts`` of rows (is_control, truth_control); label 0 is left out."""
    return confusion_of_counts(pred.where("label_id <> 0").withColumn("n", F.lit(1)), keys)


def confusion_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """tp, fp, tn, fn, precision, recall, f_score, accuracy with control (is_control = 1) as positive, from rows
    (is_control, truth_control, n)."""
    p, t = F.col("is_control") == 1, F.col("truth_control") == 1
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    c = counts.groupBy(*keys).agg(n(p & t).alias("tp"), n(p & ~t).alias("fp"), n(~p & ~t).alias("tn"), n(~p & t).alias("fn"))
    tp, fp, tn, fn = (F.col(k) for k in ("tp", "fp", "tn", "fn"))
    return c.select(*keys, tp, fp, tn, fn, F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f_score"), F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"))


def best_of_grid(scores: DataFrame, keys: list[str], score: str, points: list[str]) -> DataFrame:
    """The grid point with the greatest score of each key, ties to the least point."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), *points))
    return scores.withColumn("_r", rank).where("_r = 1").drop("_r")


def overlaps(gt: DataFrame, seg: DataFrame) -> DataFrame:
    """image, gt, seg, n: pixels of each pair of labels."""
    return gt.join(seg, ["image", "y", "x"]).groupBy("image", "gt", "seg").agg(F.count("*").alias("n"))


def iou(pairs: DataFrame) -> DataFrame:
    """image, gt, seg, iou of pairs of labels other than 0."""
    area = lambda k: F.sum("n").over(Window.partitionBy("image", k))
    return pairs.withColumn("iou", F.col("n") / (area("gt") + area("seg") - F.col("n"))).where("gt <> 0 and seg <> 0").select("image", "gt", "seg", "iou")


def segmentation_metrics(pairs: DataFrame, thresholds: list[float]) -> DataFrame:
    """image, threshold, tp, fp, fn, precision, recall, accuracy, f1: a label is found if a pair's IoU reaches the
    threshold."""
    both = iou(pairs)
    n_gt = pairs.where("gt <> 0").groupBy("image").agg(F.countDistinct("gt").alias("n_gt"))
    n_seg = pairs.where("seg <> 0").groupBy("image").agg(F.countDistinct("seg").alias("n_seg"))
    images = pairs.select("image").distinct().join(n_gt, "image", "left").join(n_seg, "image", "left").na.fill(0)
    at = images.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    found = both.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds]))).where("iou >= threshold").groupBy("image", "threshold").agg(F.countDistinct("gt").alias("tp"), F.countDistinct("seg").alias("hit"))
    t = at.join(found, ["image", "threshold"], "left").na.fill(0)
    tp, fp, fn = F.col("tp"), F.col("n_seg") - F.col("hit"), F.col("n_gt") - F.col("tp")
    return t.select("image", "threshold", tp, fp.alias("fp"), fn.alias("fn"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(tp, tp + fp + fn).alias("accuracy"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"))


def mean_ap(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("image").agg(F.avg("accuracy").alias("mean_ap"))


def fold_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std"))


def majority_label(pairs: DataFrame, cell: str = "gt", cls: str = "seg", prefer_nonzero: bool = False) -> DataFrame:
    """The class with most pixels under each cell, ties to the smaller class; with ``prefer_nonzero`` 0 only where there
    is nothing else."""
    weight = [F.col(cls) != 0] if prefer_nonzero else []
    best = F.max_by(cls, F.struct(*weight, "n", -F.col(cls)))
    return pairs.where(F.col(cell) != 0).groupBy("image", cell).agg(best.alias("majority"))


def dedup_average(rows: DataFrame, key: str, score: str, order: list[str]) -> DataFrame:
    """The first row with a score of each patient carries the mean of all its scores, other rows null; n_repeats tells how
    many scores there are."""
    own, first = Window.partitionBy(key), Window.partitionBy(key).orderBy(F.col(score).isNull(), *order)
    kept = (F.row_number().over(first) == 1) & F.col(score).isNotNull()
    return rows.withColumn("n_repeats", F.count(score).over(own)).withColumn("_mean", F.avg(score).over(own)).withColumn(score, F.when(kept, F.col("_mean"))).drop("_mean")


def false_positives(rows: DataFrame, threshold: float, ids: int = 100) -> DataFrame:
    """cohort, n_over, n, ids of rows (cohort, cohort_id, score) over the threshold; the list names the first ``ids``,
    ``false_positive_ids`` has all."""
    over = F.col("score") > threshold
    n = rows.groupBy("cohort").agg(F.count_if(over).alias("n_over"), F.count("score").alias("n"))
    rank = F.row_number().over(Window.partitionBy("cohort").orderBy("cohort_id"))
    named = rows.where(over).withColumn("_r", rank).where(F.col("_r") <= ids)
    text = named.groupBy("cohort").agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("_r", "cohort_id"))), lambda s: s["cohort_id"].cast("string"))).alias("ids"))
    return n.join(text, "cohort", "left").na.fill("", ["ids"])


def false_positive_ids(rows: DataFrame, threshold: float) -> DataFrame:
    """cohort, cohort_id of every row over the threshold."""
    return rows.where(F.col("score") > threshold).select("cohort", "cohort_id")


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int, by: list[str]) -> DataFrame:
    """by, bin (0: below, bins + 1: above), n."""
    return rows.groupBy(*by, F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def cumulative_share(counts: DataFrame, by: list[str]) -> DataFrame:
    """Running share of the counts of rows (by, bin, n): bins are few."""
    upto, whole = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*by)
    return counts.withColumn("share", F.sum("n").over(upto) / F.sum("n").over(whole))


def time_bin(days: Column) -> Column:
    """Days after onset as 0-10, 11-14 and 15 and more."""
    return F.when(days.between(0, 10), "days 0-10").when(days.between(11, 14), "days 11-14").when(days >= 15, "days 15+")


def round_robin(images: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """n rows taken from the groups in turn, each in its own order."""
    turn = images.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return turn.orderBy("turn", group).limit(n)


def rank_by_balance(images: DataFrame, skip: DataFrame) -> DataFrame:
    """image, balance: how far infected and control counts are from each other; no outliers, none of ``skip``, no zeros."""
    return images.join(skip, "image", "left_anti").where("n_infected > 0 and n_control > 0").select("image", F.abs(1 - F.col("n_infected") / F.col("n_control")).alias("balance"))
