"""Own functions of images: in blocks, whole, and on what they refuse."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.operators import hooks, pixels
from assaylake.queries.pixel_queries import disk_opening


def table(spark, arrays):
    rows = [(k, c, y, x, None if np.isnan(v) else float(v)) for (k, c), a in arrays.items() for (y, x), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "image string, channel string, y int, x int, v double")


def arrays_of(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["image"], r["channel"]), {})[r["y"], r["x"]] = r["v"]
    return {k: np.array([[p[y, x] for x in range(max(b for _, b in p) + 1)] for y in range(max(a for a, _ in p) + 1)], float) for k, p in out.items()}


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(1)
    return {("a", "m"): rng.random((17, 23)), ("a", "s"): rng.random((17, 23)), ("b", "m"): rng.random((4, 30)), (None, "m"): rng.random((1, 1))}


@pytest.mark.parametrize("block", [4, 6, 64])
def test_blocks_with_a_halo_are_as_the_whole_image(spark, images, block):
    got = arrays_of(hooks.denoised(table(spark, images), disk_opening(2), 4, block=block))
    want = {k: disk_opening(2)(v) for k, v in images.items()}
    assert got.keys() == want.keys() and all(np.array_equal(got[k], want[k]) for k in want)
    columns = pixels.gray_opening(table(spark, images).where("channel = 'm' and image is not null"), 2)
    same = arrays_of(columns.select("image", F.lit("m").alias("channel"), "y", "x", "v"))
    assert all(np.array_equal(same[k], want[k]) for k in same) and len(same) == 2


def test_a_normaliser_sees_the_whole_image(spark, images):
    got = arrays_of(hooks.normalised(table(spark, images), lambda v: v - np.median(v), block=4))
    assert all(np.array_equal(got[k], v - np.median(v)) for k, v in images.items())


def test_nulls_are_nan_and_empty_tables_stay_empty(spark):
    v = np.arange(12.0).reshape(3, 4)
    v[1, 2] = np.nan
    got = arrays_of(hooks.denoised(table(spark, {("a", "m"): v}), lambda a: a + 1, 1, block=2))
    assert np.array_equal(got["a", "m"], v + 1, equal_nan=True)
    out = hooks.normalised(table(spark, {("a", "m"): v}).limit(0), lambda a: a)
    assert out.count() == 0 and out.columns == ["image", "channel", "y", "x", "v"]


@pytest.mark.parametrize("change, message", [("y <> 1 or x <> 1", "missing"), ("twice", "twice"), ("shape", "made"), ("bound", "over the bound")])
def test_what_is_refused(spark, change, message):
    df, function, options = table(spark, {("a", "m"): np.ones((3, 3))}), lambda a: a, {}
    if change == "twice":
        df = df.union(df.where("y = 0 and x = 0"))
    elif change == "shape":
        function = lambda a: a[1:]
    elif change == "bound":
        options = {"most": 8}
    else:
        df = df.where(change)
    with pytest.raises(Exception, match=message):
        hooks.normalised(df, function, **options).collect()


def test_a_halo_beyond_a_block_is_refused(spark, images):
    with pytest.raises(ValueError):
        hooks.denoised(table(spark, images), lambda a: a, 9, block=8)
