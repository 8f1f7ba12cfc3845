"""Exact rules on small tables."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.functions import names, stats
from assaylake.operators import background, classify, evaluate, features, levels, merge, metadata, pixels, qc, scores
from assaylake.sources import readers, sinks
from assaylake.streaming import incremental


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_cell_sizes(spark):
    labels = [0] * 5 + [1] * 9 + [2] + [3] * 3 + [2] * 2 + [3] * 4 + [4]
    pixel = spark.createDataFrame([("i", k) for k in labels], "image string, label_id int")
    sizes = features.distinct_labels(pixel)
    assert rows(sizes, "label_id") == [("i", 0, 5), ("i", 1, 9), ("i", 2, 3), ("i", 3, 7), ("i", 4, 1)]
    got = qc.cell_outliers(sizes.withColumnRenamed("size", "sizes"), 4, 7)
    assert [r[-1] for r in rows(got, "label_id")] == ["none", "too_large", "too_small", "none", "too_small"]


def test_image_quality(spark):
    labels = [("few", k) for k in range(5)] + [("good", k) for k in range(50)] + [("many", k) for k in range(1500)] + [("tagged", k) for k in range(50)]
    table = spark.createDataFrame(labels, "image string, label_id int")
    tags = spark.createDataFrame([("tagged", 1), ("good", 0)], "image string, tag int")
    got = {r["image"]: (r["is_outlier"], r["outlier_type"]) for r in qc.image_outliers(table, tags).collect()}
    assert got == {"few": (1, "manual: -1; heuristic: too few cells"), "good": (0, "manual: 0; heuristic: none"), "many": (1, "manual: -1; heuristic: too many cells"), "tagged": (1, "manual: 1; heuristic: none")}
    with pytest.raises(Exception, match="manual tag"):
        qc.manual_tags(spark.createDataFrame([("a", 7)], "image string, tag int")).collect()


def test_well_quality(spark):
    wells = spark.createDataFrame([("p", "A01", 50, 0, None), ("p", "A02", 200, 9, 5.0), ("p", "A03", 200, 9, 50.0)], "plate string, well string, n_control long, n_infected long, infected_mean double")
    assert [r[3] for r in rows(qc.well_outliers(wells, 100, 1, F.lit(10.0)), "well")] == ["too few control cells;too few infected cells", "too low infected intensity", "none"]
    floors = qc.intensity_floor(spark.createDataFrame([("p", "IgG", 2.0), ("q", "IgG", None)], "plate string, channel string, mad double"), 301.23)
    assert [r[2] for r in rows(floors, "plate")] == [6.0, 301.23]


@pytest.mark.parametrize(("cohort", "letter"), [("CMV 20", "E"), ("EBV 20", "E"), ("C4k", "C"), ("2-2100 K", "K"), ("3-2100 K", "K"), ("02-2100 V", "V?"), ("??", None), (None, None), ("5-100 K", None), ("ABC", None), ("3-12/b", "b"), ("CMV", None), ("xC4", None), ("C4k anything", "C")])
def test_cohort_letters(spark, cohort, letter):
    assert one(spark, cohort, names.cohort_letter) == letter


def test_cohorts_and_lab_values(spark):
    assert [one(spark, x, names.cohort_class) for x in ("C", "c", "b", "V?", None, "k", "v", "cmv", "EBV", "Z")] == ["positive", "positive", "control", "unknown", None, "unknown", "unknown", "control", "control", "control"]
    assert [one(spark, x, names.clean_cohort_id) for x in ("B85 ", " B85", "empty", None, "CMV 7", "CMV")] == ["B85", "unknown", "unknown", "unknown", "CMV 7", "unknown"]
    assert [one(spark, x, names.lab_value) for x in (">8,5", "0.96", "11", "pos", None)] == [8.5, 0.96, 11.0, None, None]


def test_names(spark):
    name = "WellC01_PointC01_0000_ChannelDAPI,WF_GFP,TRITC,WF_Cy5_Seq0216"
    assert one(spark, name, names.well_name) == "C01" and one(spark, name, names.site_name) == "C01-0000"
    assert one(spark, name, names.channels) == ["DAPI", "WF_GFP", "TRITC", "WF_Cy5"] and one(spark, "x", names.channels) is None
    assert (one(spark, "A04", names.well_row), one(spark, "A04", names.well_column)) == (0, 3)
    assert str(one(spark, "plate9_4rep1_20200604_175423_514", names.plate_time)) == "2020-06-04 17:54:23" and one(spark, "x", names.plate_time) is None and str(one(spark, "p_20200604_rep1_5", names.plate_time)) == "2020-06-04 00:00:00"
    assert [one(spark, x, names.empty_wells) for x in ("plateT1_a", "plateK22_a", "plateK21_a", "plate9", "PlateK22rep1_x", "PlateK21rep1_x", "plateU13_T9rep1_x")] == [["H01", "G01"], ["H01", "G01"], ["H01"], ["H01"], ["H01", "G01"], ["H01"], ["H01", "G01"]]
    own = F.create_map(F.lit("plateT1_a"), F.array(F.lit("A01")))
    assert [one(spark, x, lambda c: names.empty_wells(c, own)) for x in ("plateT1_a", "plateT2_a")] == [["A01"], ["H01", "G01"]]


def test_layout(spark):
    grid = spark.createDataFrame([("20200406_210102_953", "C", "", "", "", "", "C50+55f"), ("20200406_210102_953", "H", *[None] * 4, "B85")], "plate string, row string, a string, b string, c string, d string, e string")
    got = {(r["well"]): r["cohort_id"] for r in metadata.layout(grid, list("abcde")).collect()}
    assert got["C05"] == "C50+55f" and got["H05"] == "B85" and got["C01"] == "unknown"


def test_classes_and_outliers(spark):
    cells = spark.createDataFrame([("p", "i", 0, 99.0), ("p", "i", 1, 5.0), ("p", "i", 2, 4.0), ("p", "i", 3, 9.0)], "plate string, image string, label_id int, marker double")
    ground = spark.createDataFrame([("p", 1.0, 2.0)], "plate string, median double, mad double")
    own = classify.classify(cells, ground, ["plate"], threshold=2.0)  # over 2 * 2 + 1
    assert [r[-2:] for r in rows(own, "label_id")] == [(0, 0), (0, 1), (0, 1), (1, 0)]
    bad = spark.createDataFrame([("i", 3, 1), ("i", 2, 0)], "image string, label_id int, is_outlier int")
    assert [(r["is_infected"], r["is_control"]) for r in classify.without_outliers(own, bad).orderBy("label_id").collect()] == [(0, 0), (0, 1), (0, 1), (0, 0)]


def test_background_rules(spark):
    stat = spark.createDataFrame([("sums", 100.0, 4), ("means", 25.0, 4), ("quantile0.5", 20.0, 4), ("mads", 1.0, 4), ("sizes", 4.0, 4), ("x_bg_y", 3.0, 4)], "stat string, value double, size int")
    got = [r[0] for r in stat.select(background.subtract_from_stat(F.col("stat"), F.col("value"), F.lit(10.0), F.col("size"))).collect()]
    assert got == [60.0, 15.0, 10.0, 1.0, 4.0, 3.0]
    with pytest.raises(Exception, match="no rule"):
        spark.range(1).select(background.subtract_from_stat(F.lit("other"), F.lit(1.0), F.lit(1.0), F.lit(1))).collect()
    pixel = spark.createDataFrame([("p", "A", 1, "c", 0, 1.0)], "plate string, well string, image int, channel string, label_id int, v double")
    with pytest.raises(Exception, match="background well"):
        background.from_wells(pixel, spark.createDataFrame([("p", "A"), ("p", "B")], "plate string, well string")).collect()


def test_lower_median_and_topk(spark):
    pixel = spark.createDataFrame([(1, "c", 1, v) for v in (1.0, 2.0, 3.0, 10.0)], "image int, channel string, label_id int, v double")
    assert rows(features.cell_median_mad(pixel), "image")[0][3:] == (2.0, 1.0)
    assert features.cell_topk(pixel, 2).first()["top2"] == 3.0 and features.cell_topk(pixel, 9).first()["top9"] == 0.0


def test_all_outlier_well_is_an_empty_row(spark):
    cells = spark.createDataFrame([("p", "A", 1, 1, 5.0, 50.0, 10.0, 1, 0, 0), ("p", "A", 1, 2, 5.0, 50.0, 20.0, 0, 1, 0), ("p", "B", 2, 1, 5.0, 50.0, 10.0, 1, 0, 0)], "plate string, well string, image int, label_id int, sizes double, sums double, means double, is_infected int, is_control int, is_outlier int")
    flags = spark.createDataFrame([(1, 0, "none"), (2, 1, "x")], "image int, is_outlier int, outlier_type string")
    got = {r["well"]: r for r in scores.well_table(cells, flags).collect()}
    assert got["B"]["is_outlier"] == 1 and got["B"]["outlier_type"] == "all images are outliers" and got["B"]["score"] is None
    assert got["A"]["score"] == 0.5 and got["A"]["n_cells"] == 2


def test_levels(spark):
    images = spark.createDataFrame([("p", "A", 1), ("p", "A", 2), ("p", "B", 3)], "plate string, well string, image int")
    wells = spark.createDataFrame([("p", "A", 7)], "plate string, well string, n int")
    assert levels.lift(wells, images).count() == 2 and rows(levels.missing(images, wells, ["plate", "well"]), "well") == [("p", "B")]
    with pytest.raises(Exception, match="no row"):
        levels.to_image_table(wells, images).collect()


def test_p_values():
    assert stats.student_p([2.0, 0.0, -1.5, 12.7062], [10.0, 3.0, 5.0, 1.0]).round(4).tolist() == [0.0734, 1.0, 0.1939, 0.05]
    assert round(float(stats.normal_p([1.959964])[0]), 5) == 0.05
    assert 0.39 < stats.kolmogorov_p(np.array([0.2]), np.array([40.0]), np.array([40.0]))[0] < 0.41


def test_mad_of_counts_is_mad(spark):
    random.seed(1)
    values = [(k % 3, random.randrange(50) * 1.5) for k in range(500)]
    table = spark.createDataFrame(values, "g int, v double")
    for g, m, d in rows(stats.mad_of_counts(table, ["g"], "v"), "g"):
        own = [v for k, v in values if k == g]
        assert m == statistics.median(own) and d == statistics.median(abs(v - m) for v in own)
    assert rows(stats.mad(table, ["g"], "v").select("g", "median", "mad"), "g") == rows(stats.mad_of_counts(table, ["g"], "v"), "g")


def test_mad_of_counts_holds_no_whole_group(spark, monkeypatch):
    """a group's values met in one window; now only those near the median do, and the medians are the same."""
    monkeypatch.setattr(stats, "MEDIAN_PARTS", 8)
    monkeypatch.setattr(stats, "PART_LEAST", 100)
    random.seed(14)
    own = {None: [random.gauss(0, 1) for _ in range(4000)], "odd": [random.expovariate(1) for _ in range(4001)], "ties": [random.choice([1.0, 1.0, random.random()]) for _ in range(3000)], "two": [2.0, 5.0], "one": [3.0], "ends": [float("inf")] * 900 + [float("-inf")] * 300 + [random.random() for _ in range(1500)]}
    table = spark.createDataFrame([(k, v) for k, vs in own.items() for v in vs] + [("nulls", None), ("odd", None)], "g string, v double")
    got = stats.mad_of_counts(table, ["g"], "v")
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {k: (m := statistics.median(vs), statistics.median(abs(v - m) for v in vs)) for k, vs in own.items()}
    assert {r["g"]: (r["median"], r["mad"]) for r in got.collect()} == want
    counts = table.where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("_n"))
    near = stats._near_median(counts, ["g"], "v").groupBy("g").count().collect()
    assert all(r["count"] < 1000 for r in near if r["g"] in (None, "odd"))


def test_running_sums_and_auc(spark):
    random.seed(2)
    values = [(random.randrange(40), random.randrange(2)) for _ in range(400)]
    table = spark.createDataFrame(values, "score int, truth int")
    got = {r["score"]: r["cum_truth"] for r in stats.running_sums(table, "score", ["truth"], descending=True, buckets=7).collect()}
    assert got == {s: sum(t for x, t in values if x >= s) for s in got}
    pos, neg = [s for s, t in values if t], [s for s, t in values if not t]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert evaluate.auc(table).first()["auc"] == pytest.approx(want)


def test_best_threshold_is_the_next_one(spark):
    curve = spark.createDataFrame([(9.0, 0.0, 0.5), (7.0, 0.0, 0.9), (5.0, 0.5, 0.9), (1.0, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    assert tuple(evaluate.best_threshold(curve, 1.0).first()) == (5.0, 0.0, 0.9)
    assert tuple(evaluate.best_threshold(curve.where("threshold = 1"), 1.0).first()) == (1.0, 1.0, 1.0)


def test_fold_summary(spark):
    folds = [0.659, 0.891, 0.845, 0.781, 0.861, 0.705, 0.757, 0.787, 0.798, 0.638]
    mean, std = evaluate.fold_summary(spark.createDataFrame([(x,) for x in folds], "accuracy double")).first()
    assert (round(mean, 3), round(std, 3)) == (0.772, 0.08)


def image(spark, size, draw):
    return {(y, x): draw(y, x) for y in range(size) for x in range(size)}


def test_disk_filter(spark):
    random.seed(3)
    v = image(spark, 15, lambda y, x: random.random())
    table = spark.createDataFrame([(1, y, x, k) for (y, x), k in v.items()], "image int, y int, x int, v double")
    got = {(r["y"], r["x"]): r["v"] for r in pixels.disk_filter(table, 4, largest=False).collect()}
    assert got == {(y, x): min(k for (b, a), k in v.items() if (b - y) ** 2 + (a - x) ** 2 <= 16) for y, x in v}


def test_nearest_seed_keeps_labels(spark):
    random.seed(4)
    v = image(spark, 20, lambda y, x: random.choice([0] * 30 + [1, 2]))
    table = spark.createDataFrame([(1, y, x, k) for (y, x), k in v.items()], "image int, y int, x int, seed int")
    got = {(r["y"], r["x"]): r["label"] for r in pixels.nearest_seed(table, 5).collect()}
    for (y, x), k in v.items():
        near = [((b - y) ** 2 + (a - x) ** 2, s) for (b, a), s in v.items() if s and (b - y) ** 2 + (a - x) ** 2 < 25]
        assert got[(y, x)] == (k or min(near, default=(0, 0))[1])
    assert set(got.values()) <= {0, 1, 2}
    assert all(r["label"] == 0 for r in pixels.nearest_seed(table, 5, drop_nucleus=True).collect() if v[(r["y"], r["x"])])


def test_outline_and_edges(spark):
    v = image(spark, 8, lambda y, x: 1 if 2 <= y < 6 and 2 <= x < 6 else 0)
    table = spark.createDataFrame([(1, y, x, k) for (y, x), k in v.items()], "image int, y int, x int, label_id int")
    got = {(r["y"], r["x"]): r["outline"] for r in pixels.cell_outline(table).collect()}
    assert {p for p, k in got.items() if k} == {(y, x) for (y, x), k in v.items() if k and not (3 <= y < 5 and 3 <= x < 5)}


def test_merging(spark):
    a = spark.createDataFrame([("p", 1, 2.0, 5)], "plate string, well int, mean double, n_cells int")
    b = spark.createDataFrame([("p", 1, 3.0, 6)], "plate string, well int, mean double, n_cells int")
    merged = merge.merge_tables({"IgA": b, "IgG": a}, ["plate", "well"], "IgG", ["n_cells"])
    assert merged.columns == ["plate", "well", "IgG_mean", "n_cells", "IgA_mean"] and tuple(merged.first()) == ("p", 1, 2.0, 5, 3.0)
    shown = merge.hidden(spark.createDataFrame([(1.0, 2.0)], "sum_a double, b double")).schema
    assert shown["sum_a"].metadata == {"visible": False} and shown["b"].metadata == {}
    assert merge.side_by_side(spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0)], "k int, channel string, v double"), ["k"], ["a", "b"], ["v"]).columns == ["k", "a_v", "b_v"]


def test_tables_on_disk(spark, tmp_path):
    table = spark.createDataFrame([(1, 1.234, "x", "p"), (2, None, "y", "q")], "label_id int, score1 double, some_text string, plate_name string")
    path = str(tmp_path / "t")
    sinks.write_table(table, path)
    assert rows(spark.read.parquet(path), "label_id") == rows(table, "label_id")
    with pytest.raises(Exception, match="exist"):
        sinks.write_table(table, path)
    sinks.write_table(table.where("label_id = 1").withColumn("score1", F.lit(5.0)), path, force=True)
    assert [r[1] for r in rows(spark.read.parquet(path), "label_id")] == [5.0, None]
    text = spark.createDataFrame([("1", "1.5", "a"), ("2", None, "2")], "i string, f string, s string")
    assert dict(readers.typed(text).dtypes) == {"i": "bigint", "f": "double", "s": "string"}
    (tmp_path / "tags").mkdir()
    (tmp_path / "tags" / "plateA_tagger_state.csv").write_text("filename,label\n\nWellA.h5,1\n\nWellB.h5,-1\n")
    assert rows(readers.manual_tags(spark, str(tmp_path / "tags")), "image") == [("plateA", "WellA", 1), ("plateA", "WellB", -1)]


def test_incremental(spark):
    key = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    assert rows(incremental.todo(key("a", "b", "c"), key("a", "b"), key("b"), "k"), "k") == [("b",), ("c",)]
    assert incremental.todo(key("a", "b"), key("a"), key("a"), "k", force=True).count() == 2
    checked = incremental.validated(spark.createDataFrame([(1, None), (2, 5)], "i int, v int"), {"v": F.col("v") > 1})
    assert [r["problems"] for r in checked.orderBy("i").collect()] == [["v"], []]
    with pytest.raises(Exception, match="v"):
        incremental.must_hold(spark.createDataFrame([(1, None)], "i int, v int"), {"v": F.col("v") > 1}).collect()


def test_dedup_average(spark):
    table = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 1, 5.0)], "id string, n int, score double")
    assert [(r["id"], r["n"], r["score"], r["n_repeats"]) for r in evaluate.dedup_average(table, "id", "score", ["n"]).orderBy("id", "n").collect()] == [("a", 1, 3.0, 2), ("a", 2, None, 2), ("b", 1, 5.0, 1)]


def test_quantiles_and_mad_from_one_buffer_of_a_group(spark):
    rows = [(k % 5, k, float(k * 7 % 11), int(k % 3 == 0), int(k % 3 == 1)) for k in range(60)] + [(9, 0, 2.0, 0, 1), (9, 1, None, 0, 1)]
    cells = spark.createDataFrame(rows, "well int, id int, v double, is_infected int, is_control int")
    table = scores.all_scores(cells, ["well"], ("v",))
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "percentile" not in plan
    want = stats.mad(cells.where("is_control = 1"), ["well"], "v").withColumnRenamed("median", "m")
    both = table.join(want, "well").select("`control_q0.5_of_cell_v`", "m", "control_mad_of_cell_v", "mad", "`infected_q0.5_of_cell_v`", "well").collect()
    assert len(both) == 6 and all(r[0] == r[1] and r[2] == r[3] and (r[4] is None) == (r[5] == 9) for r in both)
