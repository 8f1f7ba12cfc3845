"""Reading images, tables and settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names


def images(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Pixel tables of a folder, each row with the file and plate it is from."""
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(path).withColumn("file", F.col("_metadata.file_path")).withColumn("plate_name", names.parent_name(F.col("file")))


def channel(pixels: DataFrame, name: str, scale: int = 0) -> DataFrame:
    """One channel at one scale: partition columns, so other folders are not read."""
    return pixels.where((F.col("channel") == name) & (F.col("scale") == scale))


def typed(df: DataFrame) -> DataFrame:
    """Text columns as long where every value is one, else as double, else as text; one pass over the table decides."""
    text = [n for n, t in df.dtypes if t == "string"]
    if not text:
        return df
    lost = lambda c, kind: F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kind).isNull())
    found = df.agg(*[lost(c, k).alias(f"{c}.{k}") for c in text for k in ("bigint", "double")]).first()
    kinds = {c: "bigint" if not found[f"{c}.bigint"] else "double" if not found[f"{c}.double"] else "string" for c in text}
    return df.withColumns({c: F.col(f"`{c}`").try_cast(k) for c, k in kinds.items()})


def channel_mapping(settings: DataFrame, column: str = "json") -> DataFrame:
    """hardware, semantic rows of mapping documents; channels mapped to null are dropped."""
    return settings.select(*[c for c in settings.columns if c != column], F.explode(F.from_json(column, "map<string,string>")).alias("hardware", "semantic")).where("semantic is not null")


def manual_tags(spark: SparkSession, path: str) -> DataFrame:
    """plate, image, tag of ``<plate>_tagger_state.csv`` files below a folder, or of folders of that name that Spark wrote."""
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).schema("filename string, label int").csv(path)
    return rows.where("filename is not null").select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*?)_tagger[^/]*(?:/[^/]*)?$", 1).alias("plate"), names.file_stem(F.col("filename")).alias("image"), F.col("label").alias("tag"))


def settings(spark: SparkSession, path: str) -> DataFrame:
    """file, json, and what the folders' names say (``plate=7``), of files with one document each; a document is read whole."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(names.file_stem(F.col("_metadata.file_name")).alias("file"), F.col("value").alias("json"), *[c for c in whole.columns if c != "value"])


def background_setting(json: Column) -> tuple[Column, Column, Column]:
    """(mode, wells, fixed values) of a plate's setting: a list of wells, the text ``min``, or an object of numbers."""
    plain = F.regexp_replace(json, r"^\s+|\s+$", "")
    kind = F.substring(plain, 1, 1)
    mode = F.when(kind == "[", "wells").when(kind == "{", "fixed").when(plain.isin('"min"', "min"), "min")
    return mode, F.when(mode == "wells", F.from_json(json, "array<string>")), F.when(mode == "fixed", F.from_json(json, "map<string,double>"))


def correctors(images: DataFrame, table: DataFrame) -> DataFrame:
    """Each image with the corrector of its plate, else of its shape."""
    by_plate, by_shape = table.where("plate is not null").select("plate", F.col("corrector").alias("_p")), table.where("plate is null").select("height", "width", F.col("corrector").alias("_s"))
    return images.join(by_plate, "plate", "left").join(by_shape, ["height", "width"], "left").withColumn("corrector", F.coalesce("_p", "_s")).drop("_p", "_s")


def sheets(spark: SparkSession, path: str, sep: str = ",", skip: int = 0, columns: int = 64) -> DataFrame:
    """file (name without its ending), sheet (its folder's name), row_no, cells of files with one sheet each, as text with separators;
    ``skip`` header rows are left out, and so are cells beyond ``columns``. A sheet is read whole by one task."""
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    source = F.col("_metadata.file_path")
    lines = whole.select(names.file_stem(F.substring_index(source, "/", -1)).alias("file"), names.parent_name(source).alias("sheet"), F.posexplode(F.split("value", "\\r?\\n")).alias("row_no", "line"))
    schema = ", ".join(f"c{k} string" for k in range(columns))
    parsed = lines.where((F.col("row_no") >= skip) & (F.length("line") > 0)).withColumn("_c", F.from_csv("line", schema, {"sep": sep}))
    return parsed.select("file", "sheet", "row_no", F.array(*[F.col(f"_c.c{k}") for k in range(columns)]).alias("cells"))


def csv_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
