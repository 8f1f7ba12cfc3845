"""A keyed table that streams upsert into: rows in buckets by key, and a manifest of the buckets' files.

``<path>/data/<version>-<id>/_bucket=<k>`` has the rows of a bucket as some version left them, and
``<path>/manifest/<version>.json`` says which folder each bucket is in, and the last batch of each stream. A batch reads and
writes only the buckets that its keys are in. Its manifest comes last, so a reader sees all of a batch or nothing, and a
batch that is run again, after a failure or by another start, is known by its stream and number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.sinks import latest, upsert

#: Buckets of a new table; a bucket should hold some hundred MB.
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    version: int
    count: int
    keys: list[str]
    schema: str
    buckets: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    """(file system, a function that makes its paths)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), make


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest in the folder; None where there is none."""
    fs, make = _files(spark, path)
    folder = make(f"{path}/manifest")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    if not versions:
        return None
    stream = fs.open(make(f"{path}/manifest/{max(versions)}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _swap(spark: SparkSession, path: str, new: Manifest) -> None:
    """Put a manifest in place under its version: written aside and renamed. A version that is there already is an error."""
    fs, make = _files(spark, path)
    aside, place = make(f"{path}/manifest/.{uuid.uuid4().hex}"), make(f"{path}/manifest/{new.version}.json")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(new.__dict__).encode()))
    finally:
        stream.close()
    if fs.exists(place) or not fs.rename(aside, place):
        fs.delete(aside, False)
        raise RuntimeError(f"version {new.version} of {path} was written by someone else")


def bucket(keys: list[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version."""
    now = manifest(spark, path)
    if now is None:
        raise ValueError(f"there is no table in {path}")
    return _read(spark, path, now, list(now.buckets))


def _read(spark: SparkSession, path: str, now: Manifest, which: list[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(now.schema))
    folders = [f"{path}/{now.buckets[k]}" for k in which if k in now.buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert_batch(batch: DataFrame, number: int, path: str, keys: list[str], order: list[str], stream: str = "", count: int = BUCKETS) -> bool:
    """Upsert a batch by ``keys``, newest by ``order``; whether it was new. One writer at a time: of two, one gets an error.

    A row with null keys is a row of its own key; a batch without rows only leaves its number. Columns that are new in
    a batch are null in older rows. The driver gets the numbers of the touched buckets, which ``count`` bounds.
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    now = manifest(spark, path) or Manifest(0, count, keys, batch.schema.json())
    if now.keys != keys:
        raise ValueError(f"{path} is keyed by {now.keys}")
    if number <= now.batches.get(stream, -1):
        return False
    newest = latest(batch, keys, order).withColumn("_bucket", bucket(keys, now.count))
    touched = sorted(str(r["_bucket"]) for r in newest.select("_bucket").distinct().collect())
    moved, schema = {}, now.schema
    if touched:
        whole = upsert(_read(spark, path, now, touched), newest.drop("_bucket"), keys, order)
        schema = whole.schema.json()
        folder = f"data/{now.version + 1}-{uuid.uuid4().hex}"
        dealt = whole.withColumn("_bucket", bucket(keys, now.count)).repartition(len(touched), "_bucket")
        dealt.write.partitionBy("_bucket").parquet(f"{path}/{folder}")
        moved = {k: f"{folder}/_bucket={k}" for k in touched}
    _swap(spark, path, replace(now, version=now.version + 1, schema=schema, buckets=now.buckets | moved, batches=now.batches | {stream: number}))
    return True


def bucket_sink(path: str, keys: list[str], order: list[str], stream: str, count: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A batch function for a stream; ``stream`` names its checkpoint, as numbers begin anew with each."""

    def write(batch: DataFrame, number: int) -> None:
        upsert_batch(batch, number, path, keys, order, stream, count)

    return write


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the files that none of the last ``keep`` versions has, and older manifests; how many folders went."""
    path = path.rstrip("/")
    fs, make = _files(spark, path)
    now = manifest(spark, path)
    if now is None:
        return 0
    used: set[str] = set()
    for version in range(max(1, now.version - keep + 1), now.version + 1):
        stream = fs.open(make(f"{path}/manifest/{version}.json"))
        try:
            used |= set(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["buckets"].values())
        finally:
            stream.close()
    gone = 0
    for write in fs.listStatus(make(f"{path}/data")) if fs.exists(make(f"{path}/data")) else []:
        for part in fs.listStatus(write.getPath()):
            name = f"data/{write.getPath().getName()}/{part.getPath().getName()}"
            if part.isDirectory() and name not in used:
                gone += bool(fs.delete(part.getPath(), True))
    for old in range(1, now.version - keep + 1):
        fs.delete(make(f"{path}/manifest/{old}.json"), False)
    return gone
