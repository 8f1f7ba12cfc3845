"""Robust statistics and two-sample tests as Spark expressions; p-values in one vectorised function on small rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

QUANTILES = (0.1, 0.3, 0.5, 0.7, 0.9)


def lower_median(value: str) -> Column:
    """The middle value, the lower of two."""
    return F.expr(f"percentile_disc(0.5) within group (order by {value})")


def mad(df: DataFrame, keys: list[str], value: str, name: str = "mad", median: str = "median") -> DataFrame:
    """Per group the median and the median of absolute deviations from it.

    The window's median and the last aggregate share one exchange on the keys."""
    centred = df.withColumn("_m", F.median(value).over(Window.partitionBy(*keys)))
    return centred.groupBy(*keys).agg(F.first("_m").alias(median), F.median(F.abs(F.col(value) - F.col("_m"))).alias(name))


def quantile_of_sorted(values: Column, share: float) -> Column:
    """The quantile of a sorted array, linear between neighbours as ``percentile`` has it; null of an empty one."""
    at = (F.size(values) - 1) * F.lit(share)
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    a, b = F.get(values, low), F.get(values, high)
    return F.when(a == b, a).otherwise((high - at) * a + (at - low) * b)


#: Parts by hash of a group's distinct values; a part of fewer rows tells its whole range.
MEDIAN_PARTS, PART_LEAST = 256, 1000


def _near_median(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, _v, _n with the same medians as ``value``, ``_n`` times each, but few rows a group.

    Each part of a group tells values at its ranks 0.49 and 0.51. Less than half of each part is below the least of the former,
    so less than half of the group is, and the same above the largest of the latter: the middle ranks are between them. All values
    below and all above are one each, which leaves the median as it is."""
    v = F.col(value)
    part = counts.groupBy(*keys, F.pmod(F.xxhash64(value), F.lit(MEDIAN_PARTS)).alias("_h")).agg(F.percentile(v, F.array(F.lit(0.49), F.lit(0.51)), F.col("_n")).alias("_q"), F.min(v).alias("_a"), F.max(v).alias("_b"), F.sum("_n").alias("_s"))
    few = F.col("_s") < PART_LEAST
    ends = part.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min(F.when(few, F.col("_a")).otherwise(F.get("_q", F.lit(0)))).alias("_low"), F.max(F.when(few, F.col("_b")).otherwise(F.get("_q", F.lit(1)))).alias("_high"))
    # a last bit that an end between two values may miss; an infinite end stays
    low, high = F.least(F.col("_low") - F.abs("_low") * 1e-9, "_low"), F.greatest(F.col("_high") + F.abs("_high") * 1e-9, "_high")
    near = _with_groups(counts, ends, keys).withColumn("_v", F.when(v < low, float("-inf")).when(v > high, float("inf")).otherwise(v))
    return near.groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"))


def _median_of_counts(counts: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The keys as ``_k_`` columns, and the median of ``value``, ``_n`` times each."""
    return _near_median(counts, keys, value).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.percentile("_v", F.lit(0.5), F.col("_n")).alias(name))


def _with_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what their group has, one row of ``groups`` by ``_k_`` columns; a null is a key as others are."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(groups, on).drop(*[f"_k_{k}" for k in keys])


def mad_of_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``mad`` for groups of very many rows: values are counted first, so what is shuffled is bounded by the distinct
    values of a group, and of those only the ones near a median meet in one task."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    medians = _median_of_counts(counts, keys, value, "median")
    centred = _with_groups(counts, medians, keys).withColumn("_d", F.abs(F.col(value) - F.col("median")))
    spread = _median_of_counts(centred.select(*keys, "_d", "_n"), keys, "_d", "mad")
    both = medians.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "median")
    return _with_groups(both, spread, keys)


def welch_terms(one: Column, zero: Column, prefix: str = "") -> list[Column]:
    """Aggregates that ``welch_of`` takes: means, variances and numbers of two groups' values."""
    each = {"m1": F.avg(one), "m0": F.avg(zero), "v1": F.var_samp(one), "v0": F.var_samp(zero), "n1": F.count(one), "n0": F.count(zero)}
    return [c.alias(prefix + k) for k, c in each.items()]


def welch_of(prefix: str = "") -> tuple[Column, Column]:
    """(t, degrees of freedom) from the columns of ``welch_terms``; null where a group has under two values."""
    m1, m0, v1, v0, n1, n0 = (F.col(prefix + k) for k in ("m1", "m0", "v1", "v0", "n1", "n0"))
    a, b = F.try_divide(v1, n1), F.try_divide(v0, n0)
    enough = (n1 >= 2) & (n0 >= 2)
    t = F.try_divide(m1 - m0, F.sqrt(a + b))
    dof = F.try_divide((a + b) * (a + b), F.try_divide(a * a, n1 - 1) + F.try_divide(b * b, n0 - 1))
    return F.when(enough, t), F.when(enough, dof)


def welch(df: DataFrame, keys: list[str], value: str, group: str) -> DataFrame:
    """t and degrees of freedom of rows with group 1 against rows with group 0; no row where a group has under two."""
    one, zero = F.when(F.col(group) == 1, F.col(value)), F.when(F.col(group) == 0, F.col(value))
    t, dof = welch_of()
    return df.groupBy(*keys).agg(*welch_terms(one, zero)).where("n1 >= 2 and n0 >= 2").select(*keys, t.alias("t"), dof.alias("dof"))


#: Distinct values of a bucket of running sums, about, and how many buckets there are at most.
BUCKET_ROWS, MOST_BUCKETS = 250_000, 4096


def running_sums(df: DataFrame, order: str, values: list[str], descending: bool = False, buckets: int | None = None) -> DataFrame:
    """order, and for each value its sum and cum_<value>, its sum over all rows up to there: one row for each distinct ``order``.

    Rows are added up by ``order`` first, before and after the shuffle, so one that a third of all rows has is a row a
    task. The distinct ones are cut at approximate quantiles into buckets, by default as many as keep a bucket small, so the
    sums run in parallel: the few buckets' totals are summed first and each bucket starts from its own. A null is one more
    value, at the end where nulls sort."""
    each = df.groupBy(order).agg(*[F.sum(v).alias(v) for v in values])
    if buckets is None:
        buckets = max(8, min(MOST_BUCKETS, -(-each.count() // BUCKET_ROWS)))
    cuts = sorted(set(each.agg(F.percentile_approx(order, [k / buckets for k in range(1, buckets)])).first()[0] or []))
    # found in two steps: the run of cuts that a value is in, then its place in the run
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[k : k + step] for k in range(0, len(cuts), step)]
    below = lambda cells: F.size(F.filter(cells, lambda c: F.col(order) > c))
    bucket = F.lit(0)
    if cuts:
        array = lambda xs: F.array(*(F.lit(x) for x in xs))
        at = below(array([x[-1] for x in groups]))
        bucket = at * step + F.coalesce(below(F.get(F.array(*map(array, groups)), at)), F.lit(0))
    last = len(cuts) + 1 if descending else -1  # nulls sort first, or last where it is descending
    rows = each.withColumn("_b", F.when(F.col(order).isNotNull(), bucket * (-1 if descending else 1)).otherwise(last))
    before = Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(F.col("_b").alias("_t")).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    totals = totals.select("_t", *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values])
    within = Window.partitionBy("_b").orderBy(F.desc(order) if descending else F.asc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(F.broadcast(totals), F.col("_b") == F.col("_t"))  # one row a bucket
    return out.withColumns({f"cum_{v}": F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values}).drop("_b", "_t", *[f"_o_{v}" for v in values])


def ks(df: DataFrame, keys: list[str], value: str, group: str) -> DataFrame:
    """Largest distance of the two groups' distribution functions."""
    upto = Window.partitionBy(*keys).orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    one, zero = F.when(F.col(group) == 1, 1).otherwise(0), F.when(F.col(group) == 0, 1).otherwise(0)
    f1 = F.try_divide(F.sum(one).over(upto), F.sum(one).over(whole))
    f0 = F.try_divide(F.sum(zero).over(upto), F.sum(zero).over(whole))
    return df.where(F.col(group).isin(0, 1)).withColumn("_d", F.abs(f1 - f0)).groupBy(*keys).agg(F.max("_d").alias("ks"))


def ranksum(df: DataFrame, keys: list[str], value: str, group: str) -> DataFrame:
    """z of the rank sum of group 1, ties at their mean rank, without a correction for them."""
    order = Window.partitionBy(*keys).orderBy(value)
    rank = F.rank().over(order) + (F.count("*").over(Window.partitionBy(*keys, value)) - 1) / 2
    ranked = df.where(F.col(group).isin(0, 1)).withColumn("_r", rank)
    s = ranked.groupBy(*keys).agg(F.sum(F.when(F.col(group) == 1, F.col("_r"))).alias("s"), F.count_if(F.col(group) == 1).cast("double").alias("a"), F.count_if(F.col(group) == 0).cast("double").alias("b"))
    n = F.col("a") + F.col("b") + 1
    return s.select(*keys, F.try_divide(F.col("s") - F.col("a") * n / 2, F.sqrt(F.col("a") * F.col("b") * n / 12)).alias("z"))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function for x below (a + 1) / (a + b + 2), by its continued fraction."""
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        settled = True
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + numerator * d, 1 + numerator / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
            settled = settled and bool((np.abs(d * c - 1) < 1e-15).all())
        if settled:  # further terms would change no digit
            break
    log = np.array([math.lgamma(p + q) - math.lgamma(p) - math.lgamma(q) for p, q in zip(a, b)]) + a * np.log(x) + b * np.log1p(-x)
    return np.exp(log) * h / a


def student_p(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Two-sided p of Student's t."""
    t, dof = np.asarray(t, float), np.asarray(dof, float)
    out = np.full(len(t), np.nan)
    out[t == 0] = 1.0
    ok = np.isfinite(t) & np.isfinite(dof) & (t != 0)
    n, x = dof[ok], dof[ok] / (dof[ok] + t[ok] ** 2)
    a, b = n / 2, np.full(len(n), 0.5)
    small = x < (a + 1) / (a + b + 2)
    p = np.empty(len(n))
    p[small] = _beta_fraction(a[small], b[small], x[small])
    p[~small] = 1 - _beta_fraction(b[~small], a[~small], 1 - x[~small])
    out[ok] = p
    return out


def normal_p(z: np.ndarray) -> np.ndarray:
    """Two-sided p of a normal z."""
    return np.array([math.erfc(abs(v) / math.sqrt(2)) if np.isfinite(v) else np.nan for v in np.asarray(z, float)])


def kolmogorov_p(d: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> np.ndarray:
    """Asymptotic p of a two-sample Kolmogorov-Smirnov distance."""
    x = np.sqrt(n1 * n0 / (n1 + n0)) * d
    k = np.arange(1, 101)[:, None]
    return np.clip(2 * ((-1.0) ** (k - 1) * np.exp(-2 * k**2 * x**2)).sum(axis=0), 0, 1)


@F.pandas_udf(DoubleType())
def t_test_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(student_p(t.to_numpy(float), dof.to_numpy(float)))


@F.pandas_udf(DoubleType())
def rank_test_p(z: pd.Series) -> pd.Series:
    return pd.Series(normal_p(z.to_numpy(float)))


@F.pandas_udf(DoubleType())
def ks_test_p(d: pd.Series, n1: pd.Series, n0: pd.Series) -> pd.Series:
    ok = (d.notna() & (n1 > 0) & (n0 > 0)).to_numpy()
    out = np.full(len(d), np.nan)
    out[ok] = kolmogorov_p(d.to_numpy(float)[ok], n1.to_numpy(float)[ok], n0.to_numpy(float)[ok])
    return pd.Series(out)
