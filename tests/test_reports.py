"""Listings: order, ties, nulls, repeated rows and empty tables."""

import pytest
from pyspark.sql import functions as F

from assaylake.operators import reports

ROWS = [("p1_0001", "b", 1, 2.0, 3), ("p1_0001", "a", 2, 2.0, 0), ("p1_0001", "a", 2, 2.0, 0), ("p1_0001", "c", 3, None, 5), ("plateU2_0002", "d", 4, None, None), (None, None, None, 7.0, 9)]


@pytest.fixture(scope="module")
def images(spark):
    return spark.createDataFrame(ROWS, "plate string, name string, id int, score double, days int")


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_names_in_order(images):
    assert tuples(reports.sorted_names(images, "name")) == [("a", 2), ("b", 1), ("c", 1), ("d", 1), (None, 1)]


def test_extremes_with_ties_and_nulls(images):
    got = {r[0]: tuple(r)[1:] for r in reports.extremes(images, ["plate"], "name", "score").collect()}
    assert got["p1_0001"] == ("b", "a") and got["plateU2_0002"] == (None, None)


def test_lists_of_what_is_to_do(images):
    todo = reports.annotation_list(images, images.where("id = 3"), "id", "plate", "name")
    assert tuples(todo) == [(None, None), ("p1", "a"), ("p1", "b"), ("plateU2", "d")]
    assert sorted(map(str, tuples(reports.difference(images, images.where("id > 1"), "id")))) == ["(1,)", "(None,)"]
    again = reports.rerun_set(images.where("id < 3").select("id"), images.where("id > 1").select("id"), images.limit(0).select("id"))
    assert sorted(tuples(again)) == [(1,), (2,), (3,), (4,)]


def test_lookups_by_key(images):
    wanted = images.where("id = 2").select("id")
    assert tuples(reports.rows_of(images, wanted, "id")) == [tuple([2, *[x for k, x in enumerate(ROWS[1]) if k != 2]])] * 2
    assert reports.rows_of(images, images.where("id is null"), "id").count() == 0
    assert tuples(reports.with_status(images, images, "plate", F.col("score") > 1).where("plate is not null")) == [("p1_0001",)]


def test_cells_of_several_tables(spark, images):
    other = spark.createDataFrame([("q", 9, 1.5)], "plate string, id int, more double")
    both = reports.concat_cells([images, other], ["plate", "id"])
    assert both.count() == 7 and both.where("more = 1.5").first()["name"] is None
    with pytest.raises(ValueError, match="id"):
        reports.concat_cells([images.drop("id"), other], ["plate", "id"])
    numbers = reports.cell_numbers(images.withColumn("image", F.col("name")), ["plate"])
    assert {r["plate"]: (r["n_cells"], r["n_images"]) for r in numbers.collect()}["p1_0001"] == (4, 3)


def test_scores_by_time(images):
    got = tuples(reports.scores_by_time(images.withColumn("half", F.col("score") / 2), "id", ["score", "half"]))
    assert sorted(got, key=str) == sorted([(1, 3, "score", 2.0), (1, 3, "half", 1.0), (None, 9, "score", 7.0), (None, 9, "half", 3.5)], key=str)


def test_summaries_and_manifests(images):
    got = {(r["plate"], r["channel"]): (r["n_images"], r["source"], r["message"]) for r in reports.plate_summaries(images, ["IgG", "IgA"], F.when(F.col("plate") == "p1_0001", F.lit(1.5))).collect()}
    assert got["p1_0001", "IgG"] == (4, "fixed 1.5", "plate p1_0001: 4 images") and got["plateU2_0002", "IgA"][1] == "plate/backgrounds" and len(got) == 6
    rows = tuples(reports.submission_manifest(images.withColumn("cohort", F.lit("B")), "name", "plate", "plate"))
    assert ("d", "B", "second serum") in rows and ("plate_p1_0001.csv", None, "plate table") in rows and len(rows) == 6 + 3


def test_aliases_replace_no_view(spark, images):
    a, b = reports.aliased(images, "x"), reports.aliased(images.limit(1), "x")
    assert a != b and spark.table(a).count() == 6 and spark.table(b).count() == 1


def test_empty_tables(images):
    none = images.limit(0)
    for df in (reports.sorted_names(none, "name"), reports.extremes(none, ["plate"], "name", "score"), reports.annotation_list(none, none, "id", "plate", "name"), reports.difference(none, none, "id"), reports.rows_of(images, none, "id"), reports.scores_by_time(none, "id", ["score"])):
        assert df.count() == 0
