"""Own functions of whole images: arrays of height x width, made of pixel rows and taken apart again in Spark's tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Side of a block of an image that is processed in blocks, and pixels of an array at most.
BLOCK, MOST_PIXELS = 2048, 1 << 25


def per_image(
    pixels: DataFrame, function: Callable[[np.ndarray], np.ndarray], halo: int | None, keys: Sequence[str] = ("image", "channel"), value: str = "v", block: int = BLOCK, most: int = MOST_PIXELS
) -> DataFrame:
    """keys, y, x, value: each image's array of float64 through ``function``, which returns one of the same shape.

    With a ``halo`` the function looks at pixels up to so many rows or columns away: images are dealt to blocks with so
    much of their surroundings, so that an image of any size is spread over tasks. Without one (None) the function sees the whole
    image. An array of more than ``most`` pixels stops the job with an error, and so does an image that lacks pixels of its
    height x width or has one twice, or a result of another shape. A null value is NaN, and NaN comes back as null. An
    empty table gives no rows; other columns are dropped.
    """
    if halo is not None and not 0 <= halo <= block:
        raise ValueError("a halo is from 0 to the block's side")
    names = list(keys)
    rows = pixels.select(*names, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.col(value).cast("double").alias(value))
    sizes = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in names]).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    dealt = rows.join(sizes, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in names]).drop(*[f"_{k}" for k in names])
    for axis, side in (("y", "_h"), ("x", "_w")):
        near = F.array(F.lit(0).cast("long")) if halo is None else F.array_distinct(F.array(*[F.least(F.greatest(F.floor((F.col(axis) + d) / block), F.lit(0).cast("long")), F.floor((F.col(side) - 1) / block)) for d in (-halo, 0, halo)]))
        dealt = dealt.withColumn(f"_b{axis}", F.explode(near))
    schema = rows.select(*names, "y", "x", value).schema

    def run(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).to_pylist()[0]
        bounds = []
        for axis, side in (("y", "_h"), ("x", "_w")):
            begin, end = (0, first[side]) if halo is None else (first[f"_b{axis}"] * block, min(first[side], (first[f"_b{axis}"] + 1) * block))
            bounds.append((begin, end, max(0, begin - (halo or 0)), min(first[side], end + (halo or 0))))
        (y0, y1, top, bottom), (x0, x1, left, right) = bounds
        name = {k: first[k] for k in names}
        if (bottom - top) * (right - left) > most:
            raise ValueError(f"{name}: an array of {bottom - top} x {right - left} pixels is over the bound of {most}; give a halo, or smaller blocks")
        y, x = (table.column(c).to_numpy() for c in ("y", "x"))
        at = (y - top) * (right - left) + (x - left)
        met = np.bincount(at, minlength=(bottom - top) * (right - left)) if len(at) and at.min() >= 0 else np.zeros(1)
        if len(met) != (bottom - top) * (right - left) or (met != 1).any():
            raise ValueError(f"{name}: pixels are missing or there twice, {first['_h']} x {first['_w']} are expected")
        v = np.empty(len(at))
        v[at] = table.column(value).to_numpy(zero_copy_only=False)
        out = np.asarray(function(v.reshape(bottom - top, right - left)), float)
        if out.shape != (bottom - top, right - left):
            raise ValueError(f"{name}: the function made {out.shape} of {(bottom - top, right - left)}")
        own = out[y0 - top : y1 - top, x0 - left : x1 - left].ravel()
        n = len(own)
        ys, xs = np.divmod(np.arange(n), x1 - x0)
        repeated = {k: table.column(k).combine_chunks().take(pa.array(np.zeros(n, np.int64))) for k in names}
        return pa.table({**repeated, "y": ys + y0, "x": xs + x0, value: pa.array(own, mask=np.isnan(own))})

    return dealt.groupBy(*names, "_by", "_bx").applyInArrow(run, schema)


def denoised(pixels: DataFrame, function: Callable[[np.ndarray], np.ndarray], halo: int, **options) -> DataFrame:
    """Own denoiser: a function of an image that looks ``halo`` pixels far, as twice the radius of an opening."""
    return per_image(pixels, function, halo, **options)


def normalised(pixels: DataFrame, function: Callable[[np.ndarray], np.ndarray], **options) -> DataFrame:
    """Own normaliser: a function of the whole image, as one that takes its mean or quantiles."""
    return per_image(pixels, function, None, **options)
