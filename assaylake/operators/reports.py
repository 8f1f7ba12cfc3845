"""Listings of a study: names in order, what is to be annotated or run again, plate summaries, manifests, and lookups by key."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_names(rows: DataFrame, name: str) -> DataFrame:
    """name, n in the order of names: counted first, so what is sorted is one row a name; a null is last."""
    return rows.groupBy(name).agg(F.count("*").alias("n")).orderBy(F.asc_nulls_last(name))


def extremes(rows: DataFrame, keys: list[str], name: str, score: str) -> DataFrame:
    """keys, best and worst: the names of the greatest and the least score of each key, ties to the greater and the lesser name.
    A row without a score is neither; a key without any score has nulls."""
    by = F.when(F.col(score).isNotNull(), F.struct(score, name))
    return rows.groupBy(*keys).agg(F.max_by(name, by).alias("best"), F.min_by(name, by).alias("worst"))


def annotation_list(images: DataFrame, done: DataFrame, key: str, plate: str = "plate_name", name: str = "image_name") -> DataFrame:
    """plate, name of the images that nobody has annotated, once each and in order; the number that ends a plate's name is left out."""
    open_ = images.join(done.select(key).distinct(), key, "left_anti")
    return open_.select(F.regexp_replace(plate, "_[0-9]{4}$", "").alias(plate), name).distinct().orderBy(plate, name)


def difference(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``one`` that ``other`` lacks; null is a key like others."""
    return one.select(key).distinct().exceptAll(other.select(key).distinct())


def rerun_set(*reasons: DataFrame) -> DataFrame:
    """Distinct rows of any of the tables: what one reason or another says is to be run again."""
    return reduce(lambda a, b: a.unionByName(b), reasons).distinct()


def concat_cells(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Cell tables of several channels or plates on top of each other, columns by name, null where a table lacks one; ``keys``
    must be in all of them."""
    for df in tables:
        if missing := [k for k in keys if k not in df.columns]:
            raise ValueError(f"a table lacks {missing}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def cell_numbers(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_cells, n_images."""
    return cells.groupBy(*keys).agg(F.count("*").alias("n_cells"), F.countDistinct("image").alias("n_images"))


def rows_of(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of the table whose key is wanted, as often as the table has them; a null key is nobody's."""
    return table.join(wanted.select(key).distinct(), key, "left_semi")


def with_status(keys: DataFrame, log: DataFrame, key: str, state: Column) -> DataFrame:
    """Distinct keys that have a log row in the state."""
    return keys.select(key).distinct().join(log.where(state).select(key), key, "left_semi")


def scores_by_time(rows: DataFrame, key: str, scores: list[str], days: str = "days") -> DataFrame:
    """key, days, score, value: a row for each score of a measurement after onset (days over 0), null scores left out."""
    return rows.where(F.col(days) > 0).select(key, days, *scores).unpivot([key, days], scores, "score", "value").where("value is not null")


def plate_summaries(images: DataFrame, channels: list[str], fixed: Column, plate: str = "plate") -> DataFrame:
    """plate, channel, n_images, source, message for each plate and channel: the background's source is ``fixed`` where that
    isn't null, else the plate's own table."""
    per = images.groupBy(plate).agg(F.count("*").alias("n_images"))
    source = F.coalesce(F.concat(F.lit("fixed "), fixed.cast("string")), F.lit("plate/backgrounds"))
    return per.select(plate, F.explode(F.array(*map(F.lit, channels))).alias("channel"), "n_images", source.alias("source"), F.format_string("plate %s: %d images", F.col(plate).cast("string"), "n_images").alias("message"))


def submission_manifest(images: DataFrame, name: str = "image_name", plate: str = "plate", plate_name: str = "plate_name") -> DataFrame:
    """file, cohort, comment: each image with its cohort and serum, and one table a plate. Plates with U in their name have a
    second serum."""
    files = images.select(F.col(name).alias("file"), "cohort", F.when(F.col(plate_name).startswith("plateU"), "second serum").otherwise("serum").alias("comment"))
    tables = images.select(F.concat(F.lit("plate_"), F.col(plate).cast("string"), F.lit(".csv")).alias("file"), F.lit("plate table").alias("comment")).distinct()
    return files.unionByName(tables, allowMissingColumns=True)


def aliased(table: DataFrame, name: str) -> str:
    """The name of a view on the table: ``name`` and an id of its own, so that no other view is replaced."""
    alias = f"{name}_{uuid.uuid4().hex}"
    table.createTempView(alias)
    return alias
