"""Grids of functions, and the search over all axes of cell classification."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.operators import grid_search
from assaylake.operators.grids import Grid


def test_steps_are_called_once_for_the_axes_they_depend_on(spark):
    grid = Grid(a=[1, 2, 3], b=["x", "y"], c=[0.5, 1.5], d=[True, False])

    @grid.step
    def base(a):
        return spark.range(4).select("id", (F.col("id") * a).alias("v"))

    @grid.step
    def other(b):
        return spark.range(4).select("id", F.lit(b).alias("name"))

    @grid.step(rows=("c",))
    def both(base, other, c, by):
        assert by == ["a", "b"]
        return base.join(other, "id").withColumn("c", F.explode(F.array(*map(F.lit, c)))).withColumn("s", F.col("v") * F.col("c"))

    @grid.step
    def again(both, a, d, by):
        """An axis that a table has as well: only its rows of the same value are given."""
        assert by == ["b", "c"]
        return both.groupBy(*by).agg(F.sum("s").alias("total"), F.lit(a * 10 + d).alias("point"))

    rows = grid.table("again").collect()
    assert grid.depends("base") == ("a",) and grid.depends("both") == ("a", "b", "c") and grid.depends("again") == ("a", "b", "c", "d")
    assert grid.calls == {"base": 3, "other": 2, "both": 1, "again": 6}
    assert len(rows) == 3 * 2 * 2 * 2
    assert all(r["total"] == 6 * r["a"] * r["c"] and r["point"] == r["a"] * 10 + r["d"] for r in rows)
    assert {(r["a"], r["b"], r["c"], r["d"]) for r in rows} == set(itertools.product([1, 2, 3], "xy", [0.5, 1.5], [True, False]))
    best = grid.best("again", "total").first()
    assert (best["a"], best["b"], best["c"], best["d"]) == (3, "x", 1.5, False)
    least = grid.best("again", "total", largest=False).first()
    assert (least["a"], least["c"], least["total"]) == (1, 0.5, 3.0)
    assert {r["b"]: r["a"] for r in grid.best("again", "total", per=["b"]).collect()} == {"x": 3, "y": 3}
    assert grid.points(spark.range(2)).count() == 2 * 24


def test_wrong_steps_are_refused(spark):
    grid = Grid(a=[1])
    with pytest.raises(ValueError, match="nothing"):
        grid.step(lambda nothing: None)
    with pytest.raises(ValueError, match="axis"):
        Grid(a=[])
    with pytest.raises(ValueError, match="axis"):
        Grid(a=[1, 1])

    @grid.step(rows=("a",))
    def lost(a):
        return spark.range(1)

    with pytest.raises(ValueError, match="lost"):
        grid.table("lost")


def plain_grid(images, truth, ignored, radii, quantiles, thresholds):
    """Point by point, on arrays."""

    def opened(v, radius):
        near = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]

        def shift(v, pick, fill):
            p = np.pad(v, radius, constant_values=fill)
            return pick([p[radius + dy : radius + dy + v.shape[0], radius + dx : radius + dx + v.shape[1]] for dy, dx in near], axis=0)

        return shift(shift(v, np.min, np.inf), np.max, -np.inf) if radius else v

    out = {}
    for seg, ign, radius, q, t in itertools.product(["cells", "eroded"], ignored, radii, quantiles, thresholds):
        scores = []
        for k, (v, labels, nuclei) in images.items():
            den, lab = opened(v, radius), labels[seg]
            ground = den[lab == 0]
            med = np.median(ground)
            dev = np.median(np.abs(ground - med))
            tp = fp = fn = 0
            for c in np.unique(lab[lab != 0]):
                own = den[(lab == c) & ~(ign & (nuclei != 0))]
                if not len(own) or (k, int(c)) not in truth:
                    continue
                control, true = not np.quantile(own, q) > t * dev + med, truth[k, int(c)]
                tp, fp, fn = tp + (control and true), fp + (control and not true), fn + (true and not control)
            scores.append(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)
        out[seg, ign, radius, q, t] = np.mean(scores)
    return out


def test_search_agrees_with_each_point_by_itself(spark):
    rng = np.random.default_rng(4)
    images, rows, truth = {}, [], {}
    for k in range(3):
        v = rng.integers(0, 60, (12, 12)).astype(float)
        lab = np.zeros((12, 12), int)
        for c, (y, x) in enumerate([(1, 1), (1, 7), (7, 1), (7, 7)], 1):
            lab[y : y + 4, x : x + 4] = c
            v[y : y + 4, x : x + 4] += 40 * (c % 2)
            if c < 4 or k:
                truth[k, c] = int(rng.integers(0, 2))
        small = lab.copy()
        small[1:3] = 0
        nuclei = (rng.random((12, 12)) < 0.3).astype(int)
        images[k] = v, {"cells": lab, "eroded": small}, nuclei
        rows += [(k, y, x, float(v[y, x]), int(lab[y, x]), int(small[y, x]), int(nuclei[y, x])) for y in range(12) for x in range(12)]
    table = spark.createDataFrame(rows, "image long, y int, x int, v double, cells int, eroded int, nuclei int").cache()
    calls = []

    def segmentation(name):
        calls.append(name)
        return table.select("image", "y", "x", F.col(name).alias("label_id"))

    axes = ((True, False), (0, 1), (0.5, 0.9), (0.0, 1.5, 3.0))
    grid = grid_search.infected_cell_grid(
        table, {n: (lambda n=n: segmentation(n)) for n in ("cells", "eroded")}, segmentation("nuclei"),
        spark.createDataFrame([(k, c, v) for (k, c), v in truth.items()], "image long, label_id int, truth_control int"), *axes)
    got = {(r["segmentation"], r["ignore_nuclei"], r["denoise_radius"], r["quantile"], r["threshold"]): r["f_score"] for r in grid.table("scores").collect()}
    want = plain_grid(images, truth, *axes)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert grid.calls["denoised"] == 2 and grid.calls["labels"] == 2 and grid.calls["pixels_of_cells"] == grid.calls["statistics"] == grid.calls["confusion"] == 1
    assert calls == ["nuclei", "cells", "eroded"]
    best = grid.best("scores", "f_score").first()
    assert abs(best["f_score"] - max(want.values())) < 1e-9
