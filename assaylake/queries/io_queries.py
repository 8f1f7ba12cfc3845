"""Sinks, readers of what they wrote, and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metadata
from ..sources import readers, sinks
from ..sources.scratch import shared_folder
from ..streaming import buckets, incremental
from .name_queries import CLEAN, COHORT
from .registry import Tables, query


@query("K1_write_table", "SELECT plate, image, price + (plate = 1)::INT price FROM images")
def k1(t: Tables):
    path, rows = shared_folder(t.spark), t.images.select("plate", "image", "price")
    sinks.write_table(rows, path, by="plate")
    sinks.write_table(rows.where("plate = 1").withColumn("price", F.col("price") + 1), path, force=True, by="plate")  # one plate again
    return t.spark.read.schema("image long, price double, plate long").parquet(path)


@query("K5_export_plate_bundle", "SELECT 'wells' name, count(*) n FROM (SELECT DISTINCT plate, well FROM images) UNION ALL SELECT 'images', count(*) FROM images")
def k5(t: Tables):
    path = shared_folder(t.spark)
    sinks.export_bundle({"images": t.images.select("plate", "image", "price"), "wells": t.images.select("plate", "well").distinct()}, path)
    count = lambda name, schema: readers.csv_folder(t.spark, f"{path}/{name}", schema).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    return count("images", "plate long, image long, price double").union(count("wells", "plate long, well long"))


@query("S10_read_eval_csvs", "SELECT plate, count(*) n, sum(well % 5)::BIGINT total FROM images GROUP BY plate")
def s10(t: Tables):
    path = shared_folder(t.spark)
    sinks.export_flat(t.images.select("plate", "image", (F.col("well") % 5).alias("rating")), path)
    rows = readers.csv_folder(t.spark, path, "plate long, image long, rating int")
    return rows.groupBy("plate").agg(F.count("*").alias("n"), F.sum("rating").alias("total"))


@query("I1_stream_new_files", "SELECT user_id, count(*) n FROM events GROUP BY user_id")
def i1_stream(t: Tables):
    """Two deliveries of files, the stream started three times: every row is processed once."""
    source, out, state = shared_folder(t.spark), shared_folder(t.spark), shared_folder(t.spark)
    events = t.read("events").select("event_id", "user_id", "value")
    for part in (0, 1, None):
        if part is not None:
            events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(source)
        incremental.process_new_files(t.spark, source, events.schema, lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}"), state)
    return t.spark.read.parquet(out).groupBy("user_id").agg(F.count("*").alias("n"))


@query("I5_stream_upsert", "SELECT user_id, arg_max(\"value\", event_id) \"value\" FROM events GROUP BY user_id")
def i5_stream(t: Tables):
    """Two streams with checkpoints of their own upsert into one table, which is started three times; a repeated batch and
    a start without new files change nothing."""
    out, events = shared_folder(t.spark), t.read("events").select("event_id", "user_id", "value")
    streams = [(name, shared_folder(t.spark), shared_folder(t.spark)) for name in ("odd", "even")]
    for (name, source, state), part in zip(streams, (1, 0)):
        events.where(F.col("event_id") % 2 == part).write.parquet(source)
    for name, source, state in (*streams, streams[0]):
        incremental.process_new_files(t.spark, source, events.schema, buckets.bucket_sink(out, ["user_id"], ["event_id"], name, 16), state)
    buckets.upsert_batch(events.where("event_id % 2 = 1").limit(10), 0, out, ["user_id"], ["event_id"], "odd")
    return buckets.read_table(t.spark, out).select("user_id", "value")


#: What stands in a plate's sheets: an early block of the wells, and for every third plate a later one with the other half.
SHEETS = f"""wl AS (SELECT DISTINCT plate, well % 8 rw, well // 8 % 12 cl FROM images), ce AS (SELECT plate, rw, cl, min({COHORT}) raw FROM (SELECT plate, well, well % 8 rw, well // 8 % 12 cl FROM images) GROUP BY ALL),
nx AS (SELECT plate, rw, cl, CASE WHEN plate % 3 = 0 AND cl % 2 = 1 THEN NULL WHEN plate % 3 = 0 THEN 'C' || rw || cl ELSE raw END raw FROM ce)"""


@query("S7_sheets_of_several_plates", f"""SELECT plate || suffix plate, chr((65 + rw)::INT) || lpad((cl + 1)::VARCHAR, 2, '0') well, {CLEAN} cohort_id FROM nx, (SELECT unnest(['a', 'b']) suffix) WHERE raw IS NOT NULL AND raw <> ''
UNION ALL SELECT plate || suffix, chr((65 + rw)::INT) || lpad((cl + 1)::VARCHAR, 2, '0'), 'unknown' FROM (SELECT DISTINCT plate FROM images), (SELECT unnest(range(8)) rw), (SELECT unnest(range(12)) cl), (SELECT unnest(['a', 'b']) suffix)
WHERE (plate, rw, cl) NOT IN (SELECT (plate, rw, cl) FROM nx WHERE raw IS NOT NULL) AND (plate, rw) IN (SELECT (plate, rw) FROM ce)""", SHEETS)
def s7_sheets(t: Tables):
    """Sheets are written as files and read again: a block for each plate, in some rows behind empty columns, and a second
    block in a later file for some plates, which takes the first one's place. Each block holds for two plates."""
    cells = t.images.selectExpr("plate", "well % 8 AS rw", "well div 8 % 12 AS cl", f"{COHORT} AS raw").groupBy("plate", "rw", "cl").agg(F.min("raw").alias("raw"))
    later = cells.where("plate % 3 = 0").withColumn("raw", F.when(F.col("cl") % 2 == 0, F.concat(F.lit("C"), "rw", "cl"))).withColumn("file", F.lit("late"))
    both = cells.withColumn("file", F.lit("early")).unionByName(later)
    grid = both.groupBy("file", "plate", "rw").pivot("cl", list(range(12))).agg(F.first("raw"))
    row = F.concat(F.repeat(F.lit(","), F.col("rw") % 3), F.chr(65 + F.col("rw")), F.lit(","), F.concat_ws(",", *[F.coalesce(F.col(f"`{k}`"), F.lit("")) for k in range(12)]))
    lines = grid.select("file", "plate", F.col("rw").alias("at"), row.alias("line")).unionByName(grid.select("file", "plate", F.lit(-1).cast("long").alias("at"), F.format_string(",Plate %d ,x", "plate").alias("line")).distinct())
    path = shared_folder(t.spark)
    text = lines.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("plate", "at", "line"))), lambda r: r["line"]), "\n").alias("value"))
    text.repartition(1, "file").write.partitionBy("file").option("lineSep", "\x00").text(path)
    rows = readers.sheets(t.spark, path).withColumn("file", F.col("sheet"))
    plates = {f"Plate {k}": [f"{k}a", f"{k}b"] for k in range(25)}
    return metadata.sheet_layout(rows, plates)
