"""Criteria, predicates, curves with ties, and forests on plates they haven't seen."""

import random
from itertools import accumulate

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assaylake.functions import stats
from assaylake.operators import criteria, evaluate, learn, qc


def test_wrong_keys_are_refused():
    for limits in ({}, {"min_number_cells": 1}, criteria.IMAGE_DEFAULTS | {"max_number_cell": 3}):
        with pytest.raises(ValueError, match="missing|unknown"):
            criteria.compiled(criteria.IMAGE, limits)
    for level, defaults in ((criteria.CELL, criteria.CELL_DEFAULTS), (criteria.IMAGE, criteria.IMAGE_DEFAULTS), (criteria.WELL, criteria.WELL_DEFAULTS)):
        assert set(level) == set(defaults)


def test_compiled_criteria(spark):
    cells = spark.createDataFrame([(1, 100, None), (2, 300, 50), (3, 20_000, 50), (4, None, None)], "id int, sizes int, nucleus_sizes int")
    got = {r["id"]: (r["is_outlier"], r["outlier_type"]) for r in criteria.judged(cells, criteria.CELL, criteria.CELL_DEFAULTS | {"min_nucleus_size": 125}).collect()}
    assert got == {1: (1, "too_small"), 2: (1, "nucleus_too_small"), 3: (1, "too_large;nucleus_too_small"), 4: (0, "none")}
    none = {r["outlier_type"] for r in criteria.judged(cells, criteria.CELL, dict.fromkeys(criteria.CELL)).where("is_outlier = -1").collect()}
    assert none == {"not_checked"}
    limit = criteria.judged(cells, criteria.CELL, dict.fromkeys(criteria.CELL) | {"max_cell_size": F.col("id") * 100}).where("is_outlier = 1")
    assert [r["id"] for r in limit.orderBy("id").collect()] == [2, 3]
    assert criteria.judged(cells.limit(0), criteria.CELL, criteria.CELL_DEFAULTS).count() == 0


def test_own_predicate(spark):
    images = spark.createDataFrame([(f"im{k}", k) for k in range(30)], "image string, n int")
    tags = criteria.tags_by(images, lambda s: s.str[2:].astype(int) % 3 - 1)
    assert {r["image"]: r["tag"] for r in tags.collect()} == {f"im{k}": k % 3 - 1 for k in range(30)}
    two = criteria.tags_by(images, lambda a, n: (n > 20).astype(int), "image", "n")
    assert sum(r["tag"] for r in two.collect()) == 9
    labels = images.withColumn("label_id", F.explode(F.sequence(F.lit(0), F.lit(12))))
    got = {r["image"]: r["is_outlier"] for r in qc.image_outliers(labels, tags).collect()}
    assert got == {f"im{k}": int(k % 3 == 2) for k in range(30)}
    unchecked = {r["image"]: r["is_outlier"] for r in qc.image_outliers(labels, tags, None, None).collect()}
    assert unchecked == {f"im{k}": k % 3 - 1 for k in range(30)}
    for wrong in (lambda s: pd.Series([7] * len(s)), lambda s: pd.Series([0.5] * len(s)), lambda s: pd.Series([0]), lambda s: pd.Series([None] * len(s))):
        with pytest.raises(Exception, match="-1, 0 or 1"):
            criteria.tags_by(images, wrong).collect()
    assert criteria.tags_by(images.limit(0), lambda s: s.map(lambda _: 0)).count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_one_score_in_half_of_the_rows(spark, descending):
    rnd = random.Random(3)
    values = [(0.5 if rnd.random() < 0.5 else rnd.choice([None, *[k / 50 for k in range(50)]]), rnd.randrange(2)) for _ in range(3000)]
    table = spark.createDataFrame(values, "score double, truth int").repartition(6)
    summed = stats.running_sums(table, "score", ["truth"], descending, buckets=9)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # added up before anything is dealt
    rows = summed.collect()
    order = sorted({s for s, _ in values}, key=lambda s: (s is None if descending else s is not None, (-s if descending else s) if s is not None else 0))
    each = [sum(t for x, t in values if x == s) for s in order]
    assert len(rows) == len(order) and {r["score"]: (r["truth"], r["cum_truth"]) for r in rows} == dict(zip(order, zip(each, accumulate(each))))
    most = summed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert most <= len(order)
    pos, neg = [s for s, t in values if t and s is not None], [s for s, t in values if not t and s is not None]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert evaluate.auc(table).first()["auc"] == pytest.approx(want)
    curve = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_curve(table).collect()}
    assert all(curve[s] == (sum(x >= s for x in neg) / len(neg), sum(x >= s for x in pos) / len(pos)) for s in curve)


def test_forest_is_judged_on_plates_it_has_not_seen(spark):
    rnd = random.Random(6)
    rows = []
    for plate in range(5):
        for k in range(160):
            a, b = rnd.random(), rnd.random()
            rows.append((plate, k, a, b, rnd.random(), float((a > 0.5) != (b > 0.5)), int(k % 40 == 0)))
    cells = spark.createDataFrame(rows, "plate int, cell int, a double, b double, c double, truth double, is_outlier int")
    out = learn.held_out_forest(cells, ["a", "b", "c"], "truth", F.col("plate"), 5, trees=20, depth=6)
    assert out.count() == len(rows) and {r["fold"] for r in out.select("fold").distinct().collect()} == set(range(5))
    scores = learn.fold_confusion(out, "truth").collect()
    assert all(r["tp"] + r["fp"] + r["tn"] + r["fn"] == 160 for r in scores)
    single = cells.select(F.lit(0).alias("fold"), (F.col("a") > 0.5).cast("int").alias("prediction"), "truth")
    assert min(r["f_score"] for r in scores) > 0.85 > 0.6 > learn.fold_confusion(single, "truth").first()["f_score"]
    alike = learn.held_out_forest(cells.withColumn("truth", (F.col("plate") == 0).cast("double")), ["a"], "truth", F.col("plate"), 5, trees=2, depth=2)
    assert {r["prediction"] for r in alike.where("plate = 0").select("prediction").distinct().collect()} == {0}
    assert learn.held_out_forest(cells.limit(0), ["a"], "truth", F.col("plate"), 2).count() == 0
    with pytest.raises(ValueError):
        learn.held_out_forest(cells, ["a"], "truth", F.col("plate"), 1)
    assert {r[0] for r in cells.select(learn.fold_of("plate", 3)).distinct().collect()} <= {0, 1, 2}


def test_forest_is_trained_on_as_many_points_whatever_the_rows(spark):
    cells = spark.range(400).selectExpr("id % 7 a", "id * 0.37 % 5 b", "double(id % 7 > 3) truth", "int(id % 50 = 0) is_outlier")
    many = cells.crossJoin(spark.range(30).select(F.col("id").alias("copy")))
    assert [len(x) for x in learn.bins_of(cells, ["a"]).getSplitsArray()] == [8]  # each of seven values has a bin of its own
    bins = learn.bins_of(many, ["a", "b"])
    once, often = (learn.counted(c, bins, ["truth"]) for c in (cells, many))
    assert often.count() == once.count() and often.agg(F.sum("n")).first()[0] == 400 * 30
    told = learn.train_forest(many, ["a", "b"], "truth", trees=10, depth=4).transform(many)
    assert told.count() == 400 * 30 and told.where("prediction <> truth").count() == 0
    gaps = cells.withColumn("a", F.when(F.col("a") > 0, F.col("a").cast("double"))).withColumn("b", F.when(F.col("b") < 0.5, float("nan")).otherwise(F.col("b")))
    out = learn.held_out_forest(gaps, ["a", "b"], "truth", F.col("is_outlier"), 2, trees=2, depth=2)
    assert out.count() == gaps.where("a is not null and not isnan(b)").count() > 0
