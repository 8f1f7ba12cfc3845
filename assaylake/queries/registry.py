"""Queries by name, each with the DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.plate_analysis import Settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Limits that fit the driver's tables, which have about four cells an image and forty a well.
SMALL = Settings(threshold=0.55, smallest_cell=5, largest_cell=45, fewest_cells=2, most_cells=6, min_control=15)


class Tables:
    """The driver's tables as assay data: plate = nation, well = customer, image = order, cell = line."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def images(self) -> DataFrame:
        """plate, well, image, and the names that files of such an image have."""
        o, c = self.read("orders"), self.read("customer")
        at = F.concat(F.chr(65 + F.col("well") % 8), F.lpad((F.floor(F.col("well") / 8) % 12 + 1).cast("string"), 2, "0"))
        num = F.lpad((F.col("image") % 10000).cast("string"), 4, "0")
        rows = o.join(c, o["o_custkey"] == c["c_custkey"]).select(F.col("c_nationkey").cast("long").alias("plate"), F.col("o_custkey").alias("well"), F.col("o_orderkey").alias("image"), F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
        rows = rows.withColumn("image_name", F.concat(F.lit("Well"), at, F.lit("_Point"), at, F.lit("_"), num, F.lit("_ChannelDAPI,WF_GFP,TRITC_Seq"), num))
        kind = F.get(F.array(*[F.lit(x) for x in "KTUA"]), (F.col("plate") % 4).cast("int"))
        return rows.withColumn("plate_name", F.concat(F.lit("plate"), kind, F.col("plate").cast("string"), F.lit("_rep1_2020"), F.date_format("day", "MMdd"), F.lit("_"), F.lpad((F.col("well") % 24).cast("string"), 2, "0"), F.lit("1530_"), num))

    @cached_property
    def cells(self) -> DataFrame:
        """plate, well, image, label_id from 0, sizes, sums, means, marker, second, tag."""
        line = self.read("lineitem")
        order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
        rows = line.withColumn("label_id", F.row_number().over(order) - 1)
        tag = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).otherwise(-1)
        rows = rows.select(F.col("l_orderkey").alias("image"), "label_id", F.col("l_quantity").alias("sizes"), F.col("l_extendedprice").alias("sums"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("means"), F.col("l_tax").alias("marker"), F.col("l_discount").alias("second"), tag.alias("tag"))
        return rows.join(self.images.select("plate", "well", "image"), "image")

    @cached_property
    def classified(self) -> DataFrame:
        from ..plans.plate_analysis import classified_cells

        return classified_cells(self.cells, SMALL)

    @cached_property
    def tags(self) -> DataFrame:
        """image, tag: the largest tag of an image's cells; images of even number have none."""
        return self.cells.where("image % 2 = 1").groupBy("image").agg(F.max("tag").alias("tag"))

    @cached_property
    def flags(self) -> DataFrame:
        from ..operators import qc

        return qc.image_outliers(self.cells, self.tags, SMALL.fewest_cells, SMALL.most_cells)

    @cached_property
    def pixels(self) -> DataFrame:
        """plate, well, image, channel, y, x, v, label_id: embeddings as images of 8 by 8, four quadrants as labels."""
        e = self.read("embeddings").select((F.col("vec_id") % 5).alias("plate"), F.col("label").cast("long").alias("well"), F.col("vec_id").alias("image"), F.posexplode("embedding").alias("pos", "v"))
        y, x = F.floor(F.col("pos") / 8), F.col("pos") % 8
        return e.select("plate", "well", "image", F.lit("serum").alias("channel"), y.cast("int").alias("y"), x.cast("int").alias("x"), F.col("v").cast("double").alias("v"), (F.floor(y / 4) * 2 + F.floor(x / 4)).cast("int").alias("label_id"))

    @cached_property
    def pixel_flags(self) -> DataFrame:
        """image, is_outlier: every seventh image."""
        return self.read("embeddings").select(F.col("vec_id").alias("image"), (F.col("vec_id") % 7 == 3).cast("int").alias("is_outlier"))

    @cached_property
    def scored(self) -> DataFrame:
        """doc_id, score, truth: text lengths as scores of labelled documents."""
        return self.read("labels").join(self.read("documents"), "doc_id").select("doc_id", F.col("n_chars").cast("double").alias("score"), F.col("quality").cast("long").alias("truth"), "lang", "source")


#: The same tables as CTEs.
CTES = """
imgs AS (SELECT c.c_nationkey::BIGINT plate, o.o_custkey well, o.o_orderkey image, o.o_orderdate "day", o.o_totalprice price, o.o_orderpriority priority,
  chr((65 + o.o_custkey % 8)::INT) || lpad((o.o_custkey // 8 % 12 + 1)::VARCHAR, 2, '0') spot, lpad((o.o_orderkey % 10000)::VARCHAR, 4, '0') num
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
images AS (SELECT plate, well, image, "day", price, priority, spot, num, 'Well' || spot || '_Point' || spot || '_' || num || '_ChannelDAPI,WF_GFP,TRITC_Seq' || num image_name,
  'plate' || substr('KTUA', (plate % 4 + 1)::INT, 1) || plate::VARCHAR || '_rep1_2020' || strftime("day", '%m%d') || '_' || lpad((well % 24)::VARCHAR, 2, '0') || '1530_' || num plate_name FROM imgs),
cells AS (SELECT i.plate, i.well, i.image, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS label_id,
  l_quantity sizes, l_extendedprice sums, l_extendedprice / l_quantity means, l_tax marker, l_discount AS "second", CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE -1 END tag
  FROM lineitem JOIN imgs i ON l_orderkey = i.image),
bg AS (SELECT plate, median(marker) med, mad(marker) dev FROM cells WHERE label_id = 0 GROUP BY plate),
classed AS (SELECT c.*, CASE WHEN label_id <> 0 AND marker > dev * 0.55 + med THEN 1 ELSE 0 END inf0, CASE WHEN label_id <> 0 AND NOT marker > dev * 0.55 + med THEN 1 ELSE 0 END ctl0,
  CASE WHEN sizes > 45 OR sizes < 5 THEN 1 ELSE 0 END is_outlier FROM cells c JOIN bg USING (plate)),
classified AS (SELECT *, CASE WHEN is_outlier = 1 THEN 0 ELSE inf0 END is_infected, CASE WHEN is_outlier = 1 THEN 0 ELSE ctl0 END is_control FROM classed),
tags AS (SELECT image, max(tag) tag FROM cells WHERE image % 2 = 1 GROUP BY image),
flags0 AS (SELECT image, count(DISTINCT label_id) - 1 n FROM cells GROUP BY image),
flags AS (SELECT image, CASE WHEN coalesce(tag, -1) = 1 THEN 1 WHEN n < 2 OR n > 6 THEN 1 ELSE 0 END is_outlier,
  'manual: ' || coalesce(tag, -1)::VARCHAR || '; heuristic: ' || CASE WHEN n < 2 THEN 'too few cells' WHEN n > 6 THEN 'too many cells' ELSE 'none' END outlier_type FROM flags0 LEFT JOIN tags USING (image)),
pix0 AS (SELECT vec_id image, label::BIGINT well, vec_id % 5 plate, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE v FROM embeddings),
pixels AS (SELECT plate, well, image, 'serum' channel, (pos // 8)::INT y, (pos % 8)::INT x, v, ((pos // 8 // 4) * 2 + pos % 8 // 4)::INT label_id FROM pix0),
pixel_flags AS (SELECT vec_id image, CASE WHEN vec_id % 7 = 3 THEN 1 ELSE 0 END is_outlier FROM embeddings),
scored AS (SELECT doc_id, n_chars::DOUBLE score, quality::BIGINT truth, lang, source FROM labels JOIN documents USING (doc_id))
"""


def six(expression: str) -> str:
    """SQL for a double rounded to six digits, by operations that give the same bits in both engines. Just off one half,
    as exact halves, which a sum in another order misses by a bit, must fall one way."""
    return f"(floor(({expression})::DOUBLE * 1e6 + 0.4987) / 1e6)"


def r(expression: str, name: str) -> str:
    """A rounded SQL column."""
    return f"{six(expression)} AS {name}"


def student_sql(t: str, dof: str) -> str:
    """Two-sided p of Student's t in SQL: one less the integral of cos(u) ** (dof - 1), by Simpson's rule."""
    theta = f"atan(abs({t}) / sqrt({dof}))"
    area = f"list_sum(list_transform(range(0, 2001), lambda k: (CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * pow(cos(k * {theta} / 2000), {dof} - 1))) * {theta} / 6000"
    return f"(1 - 2 / sqrt(pi()) * exp(lgamma(({dof} + 1) / 2) - lgamma({dof} / 2)) * {area})"


def normal_sql(z: str) -> str:
    """Two-sided p of a normal z in SQL, by the power series of the error function; 0 to six digits beyond 6."""
    x = f"(abs({z}) / sqrt(2))"
    series = f"list_sum(list_transform(range(0, 110), lambda n: (CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) * exp((2 * n + 1) * ln({x}) - lgamma(n + 1)) / (2 * n + 1)))"
    return f"(CASE WHEN {z} = 0 THEN 1.0 WHEN abs({z}) > 6 THEN 0.0 ELSE 1 - 2 / sqrt(pi()) * {series} END)"


def plain(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits, as sums depend on their order; integers as long; lists and documents as text; names without dots."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("double", "float"):
            column = F.floor(column.cast("double") * 1e6 + 0.4987) / 1e6
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("long")
        elif kind == "array<string>":
            column = F.array_join(column, ",")
        elif kind.startswith(("array", "struct", "map")):
            column = F.to_json(column)
        out.append(column.alias(name.replace(".", "_")))
    return df.select(*out)


def query(name: str, sql: str | None = None, ctes: str = "") -> Callable:
    """Registers a function of ``Tables`` under a name; sql may use the CTEs above and its own."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: plain(f(Tables(spark, sf_dir)))
        if sql is not None:
            SQL[name] = f"WITH {CTES.strip()}{',' + ctes if ctes else ''}\n{sql.strip()}"
        return f

    return add
