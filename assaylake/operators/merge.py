"""Merging channel tables, exports across plates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_pattern(df: DataFrame, patterns: list[str], always: list[str] = []) -> DataFrame:
    """Columns whose name contains any of the patterns, after the ``always`` ones."""
    return df.select(*always, *[F.col(f"`{c}`") for c in df.columns if c not in always and any(p in c for p in patterns)])


def side_by_side(long: DataFrame, keys: list[str], channels: list[str], values: list[str]) -> DataFrame:
    """Rows (keys, channel, values) as one row a key with <channel>_<value>: a pivot, joined on the key by one shuffle."""
    wide = long.groupBy(*keys).pivot("channel", channels).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])
    return wide if len(values) > 1 else wide.withColumnsRenamed({c: f"{c}_{values[0]}" for c in channels})


def merge_tables(tables: dict[str, DataFrame], keys: list[str], reference: str, reference_only: list[str], marker: str = "marker") -> DataFrame:
    """Tables of channels joined on their keys: the reference's ``reference_only`` columns once, marker columns from the
    first table that has them, other columns as <channel>_<name>."""
    order = [reference, *(c for c in tables if c != reference)]
    out, had = None, set()
    for channel in order:
        own = tables[channel]
        names = {}
        for c in own.columns:
            if c in keys:
                continue
            if c in reference_only:
                if channel == reference:
                    names[c] = c
            elif c.startswith(marker):
                if c not in had:
                    names[c] = c
                    had.add(c)
            else:
                names[c] = f"{channel}_{c}"
        part = own.select(*keys, *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
        out = part if out is None else out.join(part, keys, "full")
    return out


def means_and_sums(means: DataFrame, sums: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of run A, those that name sums from run B."""
    b = sums.select(*keys, *[F.col(f"`{c}`").alias(f"_b_{c}") for c in sums.columns if "sum" in c and c not in keys])
    joined = means.join(b, keys)
    picked = [F.col(f"`_b_{c}`").alias(c) if f"_b_{c}" in b.columns else F.col(f"`{c}`") for c in means.columns]
    return joined.select(*picked)


def hidden(df: DataFrame, part: str = "sum") -> DataFrame:
    """Columns that a viewer hides get ``visible: False`` in their metadata."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"visible": False}) if part in c or c == "image_name" else F.col(f"`{c}`") for c in df.columns])


def union_plates(plates: list[DataFrame]) -> DataFrame:
    """Tables of plates with different columns in one; what a plate lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), plates)


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """Floating columns rounded, for export."""
    floating = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.round(c, digits).alias(c) if c in floating else F.col(f"`{c}`") for c in df.columns])


def with_properties(cells: DataFrame, properties: DataFrame) -> DataFrame:
    """Cells with the centroid of the same label; cells without one keep nulls."""
    return cells.join(properties.select("image", "label_id", "anchor_y", "anchor_x"), ["image", "label_id"], "left")


def joined_notes(new: Column, old: Column) -> Column:
    """Notes of an image, the new one first."""
    return F.concat_ws("; ", new, old)
