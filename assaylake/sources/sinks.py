"""Writing tables: replace or keep, pyramids, exports, and keyed results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import merge, pixels


def write_table(df: DataFrame, path: str, force: bool = False, by: str = "plate_name") -> None:
    """One folder a plate. With ``force`` only the plates in ``df`` are replaced; without, an existing table is an error."""
    writer = df.write.partitionBy(by)
    if force:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("errorifexists").parquet(path)


def pyramid(channel: DataFrame, factors: list[int]) -> DataFrame:
    """image, y, x, v, scale: the channel and its down-scaled versions, each from the one before."""
    out, level = channel.select("image", "y", "x", "v").withColumn("scale", F.lit(0)), channel
    for k, factor in enumerate(factors, 1):
        level = pixels.downscale(level, factor)
        out = out.unionByName(level.withColumn("scale", F.lit(k)))
    return out


def write_pyramid(channel: DataFrame, factors: list[int], path: str) -> None:
    pyramid(channel, factors).write.mode("overwrite").partitionBy("scale").parquet(path)


def export_flat(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV or TSV with a header and floats of two digits."""
    merge.rounded(df).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def cell_export(cells: DataFrame, properties: DataFrame) -> DataFrame:
    """Cells of all images with plate, well, image and centroid in front."""
    return merge.with_properties(cells, properties).select("plate", "well", "image", "anchor_y", "anchor_x", "label_id", *[c for c in cells.columns if c not in ("plate", "well", "image", "label_id")])


def export_bundle(tables: dict[str, DataFrame], path: str) -> None:
    for name, table in tables.items():
        export_flat(table, f"{path.rstrip('/')}/{name}")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key: a rank limit of 1, which Spark applies before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Old rows replaced by new ones of their key; applying the same rows again changes nothing."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, [*order, "_new"]).drop("_new")
