"""Names, cohorts, settings, metadata and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import evaluate, levels, metadata, qc, reports
from ..operators.grids import Grid
from ..sources import readers, sinks
from ..sources.scratch import shared_folder
from ..streaming import incremental
from .registry import Tables, query, r

#: Cohort ids made from customers: forms that the patterns know and forms near them, by the id's remainder.
COHORT = "CASE well % 12 WHEN 0 THEN 'CMV ' || well WHEN 1 THEN 'EBV ' || well WHEN 2 THEN 'C' || well || 'k' WHEN 3 THEN '2-' || well || ' K' WHEN 4 THEN '02-' || well || ' V' WHEN 5 THEN 'Z' || well WHEN 6 THEN 'B' || well || ' ' WHEN 7 THEN '5-' || well || ' K' WHEN 8 THEN 'ABC' WHEN 9 THEN '3-' || well || '/b' WHEN 10 THEN 'CMV' ELSE ' A1' END"
LETTER = "CASE WHEN regexp_matches({c}, '^CMV.+') THEN 'E' WHEN regexp_matches({c}, '^EBV.+') THEN 'E' WHEN regexp_matches({c}, '^3-.+') THEN right({c}, 1) WHEN regexp_matches({c}, '^2-.+') THEN right({c}, 1) WHEN regexp_matches({c}, '^02-.+') THEN right({c}, 1) || '?' WHEN regexp_matches({c}, '^[A-Z][0-9]+') THEN substr({c}, 1, 1) END"
CLEAN = "CASE WHEN " + LETTER.format(c="raw") + " IS NULL THEN 'unknown' ELSE trim(raw) END"
CLASS = "CASE WHEN letter IS NULL THEN NULL WHEN lower(letter) = 'c' THEN 'positive' WHEN lower(letter) IN ('b', 'a', 'x', 'z', 'e', 'cmv', 'ebv') THEN 'control' ELSE 'unknown' END"
PEOPLE = f"raws AS (SELECT DISTINCT plate, well, {COHORT} raw FROM images), ids AS (SELECT plate, well, raw, {CLEAN} cohort_id FROM raws), people AS (SELECT plate, well, cohort_id, {LETTER.format(c='cohort_id')} letter FROM ids), classes AS (SELECT *, {CLASS} cohort_type FROM people)"


def people(t: Tables):
    """plate, well, cohort_id, cohort, cohort_type."""
    return t.images.selectExpr("plate", "well", f"{COHORT} AS raw").distinct().select("plate", "well", names.clean_cohort_id(F.col("raw")).alias("cohort_id")).withColumn("cohort", names.cohort_letter(F.col("cohort_id"))).withColumn("cohort_type", names.cohort_class(F.col("cohort")))


@query("P1_image_name_parts", "SELECT image, spot well_name, spot || '-' || num site_name FROM images")
def p1(t: Tables):
    return t.images.select("image", names.well_name(F.col("image_name")).alias("well_name"), names.site_name(F.col("image_name")).alias("site_name"))


@query("P1_file_name_parts", "SELECT page_id, regexp_replace(list_last(string_split(url, '/')), '\\.[^.]*$', '') stem, string_split(url, '/')[-2] parent FROM pages")
def p1_files(t: Tables):
    return t.read("pages").select("page_id", names.file_stem(F.col("url")).alias("stem"), names.parent_name(F.col("url")).alias("parent"))


@query("P2_add_site_name", "SELECT image_name, spot || '-' || num site_name, price FROM images")
def p2(t: Tables):
    return t.images.select("image_name", names.site_name(F.col("image_name")).alias("site_name"), "price")


@query("P3_parse_channels", "SELECT image, 'DAPI,WF_GFP,TRITC' channels FROM images")
def p3(t: Tables):
    return t.images.select("image", names.channels(F.col("image_name")).alias("channels"))


@query("P4_check_channels_consistent", "SELECT plate, 1::BIGINT n_lists, 'TRITC' unmapped FROM images GROUP BY plate")
def p4(t: Tables):
    listed = t.images.withColumn("channels", names.channels(F.col("image_name")))
    known = F.array(F.lit("DAPI"), F.lit("WF_GFP"))
    return listed.groupBy("plate").agg(F.countDistinct("channels").alias("n_lists"), F.array_except(F.first("channels"), known).alias("unmapped"))


@query("P5_well_to_rowcol", "SELECT image, well % 8 AS \"row\", well // 8 % 12 col FROM images")
def p5(t: Tables):
    at = names.well_name(F.col("image_name"))
    return t.images.select("image", names.well_row(at).alias("row"), names.well_column(at).alias("col"))


@query("P16_cohort_of", "SELECT plate, well, cohort_id, letter cohort FROM people", PEOPLE)
def p16(t: Tables):
    return people(t).drop("cohort_type")


@query("P17_cohort_class", "SELECT cohort_type, count(*) n FROM classes GROUP BY cohort_type", PEOPLE)
def p17(t: Tables):
    return people(t).groupBy("cohort_type").agg(F.count("*").alias("n"))


@query("P18_clean_cohort_id", "SELECT cohort_id, count(*) n FROM ids GROUP BY cohort_id", PEOPLE)
def p18(t: Tables):
    return people(t).groupBy("cohort_id").agg(F.count("*").alias("n"))


@query("P19_parse_lab_value", "SELECT image, CASE WHEN image % 11 = 0 THEN NULL ELSE price::DOUBLE END lab_value FROM images")
def p19(t: Tables):
    written = F.when(F.col("image") % 11 == 0, "pos").when(F.col("image") % 2 == 0, F.concat(F.lit(">"), F.replace(F.col("price").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")))).otherwise(F.col("price").cast("decimal(18,2)").cast("string"))
    return t.images.select("image", names.lab_value(written).alias("lab_value"))


@query("P20_control_positive_wells", "SELECT plate, well FROM classes WHERE cohort_type IN ('positive', 'control')", PEOPLE)
def p20(t: Tables):
    return metadata.wells_of_type(people(t), ["positive", "control"])


@query("P21_plate_timestamp", "SELECT image, strptime('2020' || strftime(\"day\", '%m%d') || ' ' || lpad((well % 24)::VARCHAR, 2, '0') || '1530', '%Y%m%d %H%M%S') created_at FROM images")
def p21(t: Tables):
    return t.images.select("image", names.plate_time(F.col("plate_name")).alias("created_at"))


@query("P22_bg_well_rule", "SELECT DISTINCT plate, CASE WHEN plate % 4 IN (1, 2) OR plate % 4 = 0 AND plate >= 22 THEN 'H01,G01' ELSE 'H01' END wells FROM images")
def p22(t: Tables):
    return t.images.select("plate", names.empty_wells(F.col("plate_name")).alias("wells")).distinct()


@query("P23_plate_selection", "SELECT DISTINCT plate FROM images WHERE plate % 4 IN (0, 1) AND plate NOT IN (4, 5)")
def p23(t: Tables):
    chosen = t.images.where(F.col("plate_name").rlike("^plate[KT]")).select("plate").distinct()
    return chosen.join(t.images.where(F.col("plate_name").rlike("^plate[KT][45]_")).select("plate"), "plate", "left_anti")


@query("P26_format_column_names", "SELECT stat, CASE stat WHEN 'n_cells' THEN 'n_cells' WHEN 'serum_ratio_of_means' THEN 'IgG_ratio_of_means' ELSE 'IgG_mean_means' END name, count(*) n FROM cells, (SELECT unnest(['n_cells', 'serum_ratio_of_means', 'serum_mean_of_cell_means']) stat) GROUP BY ALL")
def p26(t: Tables):
    long = t.cells.select(F.explode(F.array(*[F.lit(x) for x in ("n_cells", "serum_ratio_of_means", "serum_mean_of_cell_means")])).alias("stat"))
    name = names.display_name(F.col("stat"), F.lit("serum_IgG"), F.col("stat") == "n_cells")
    return long.groupBy("stat", name.alias("name")).agg(F.count("*").alias("n"))


@query("P27_select_channel", "SELECT plate, CASE WHEN bool_or(priority = '3-MEDIUM') THEN '3-MEDIUM' ELSE min(priority) END channel FROM images GROUP BY plate")
def p27(t: Tables):
    prefer = F.struct(~F.col("priority").endswith("MEDIUM"), F.col("priority"))
    return t.images.groupBy("plate").agg(F.min_by("priority", prefer).alias("channel"))


@query("P28_manual_qc_filters", "SELECT image, CASE WHEN priority = '1-URGENT' OR plate % 4 = 3 THEN NULL ELSE price END score FROM images WHERE priority IN ('1-URGENT', '2-HIGH', '5-LOW') AND NOT regexp_matches(image_name, '.*[0-4]$') AND substr(plate_name, 6, 1) <> 'U'")
def p28(t: Tables):
    kept = t.images.where(F.col("priority").isin("1-URGENT", "2-HIGH", "5-LOW") & ~F.col("image_name").rlike(".*[0-4]$") & ~F.col("plate_name").startswith("plateU"))
    return kept.select("image", F.when(~(F.col("priority").isin("1-URGENT") | F.col("plate_name").startswith("plateA")), F.col("price")).alias("score"))


@query("P29_label_truth", "SELECT plate, well, (cohort_type = 'positive')::INT::BIGINT truth FROM classes", PEOPLE)
def p29(t: Tables):
    return people(t).select("plate", "well", (F.col("cohort_type") == "positive").cast("int").alias("truth"))


@query("P30_time_bin", "SELECT image, CASE WHEN well % 30 <= 10 THEN 'days 0-10' WHEN well % 30 <= 14 THEN 'days 11-14' ELSE 'days 15+' END bin FROM images")
def p30(t: Tables):
    return t.images.select("image", evaluate.time_bin(F.col("well") % 30).alias("bin"))


@query("P31_bg_parameter_resolve", f"SELECT plate, CASE WHEN plate % 3 = 0 THEN 300.5 ELSE {'floor(med * 1e6 + 0.4987) / 1e6'} END background FROM bg")
def p31(t: Tables):
    from ..plans.plate_analysis import marker_background

    setting = t.images.select("plate").distinct().withColumn("fixed", F.when(F.col("plate") % 3 == 0, 300.5))
    return setting.join(marker_background(t.cells), "plate").select("plate", F.coalesce("fixed", "median").alias("background"))


@query("P33_rows_by_key", "SELECT image, price, priority FROM images WHERE image % 10 = 1")
def p33(t: Tables):
    return reports.rows_of(t.images.select("image", "price", "priority"), t.images.where("image % 10 = 1"), "image")


@query("P35_score_vs_time", "SELECT image, 'price' score, well % 30 AS \"days\", price \"value\" FROM images WHERE well % 30 > 0 UNION ALL SELECT image, 'half', well % 30, price / 2 FROM images WHERE well % 30 > 0")
def p35(t: Tables):
    rows = t.images.select("image", (F.col("well") % 30).alias("days"), "price", (F.col("price") / 2).alias("half"))
    return reports.scores_by_time(rows, "image", ["price", "half"])


GRID = "grid AS (SELECT plate, well % 8 AS rw, well // 8 % 12 cl, min(" + COHORT + ") raw FROM images GROUP BY ALL)"


@query("S7_read_cohort_sheets", f"SELECT plate, chr((65 + rw)::INT) || lpad((cl + 1)::VARCHAR, 2, '0') well, {CLEAN} cohort_id FROM grid", GRID)
def s7(t: Tables):
    cells = t.images.selectExpr("plate", "chr(65 + well % 8) AS row", "well div 8 % 12 AS col", f"{COHORT} AS raw")
    columns = [f"c{k}" for k in range(12)]
    sheet = cells.groupBy("plate", "row").pivot("col", list(range(12))).agg(F.min("raw")).toDF("plate", "row", *columns)
    present = cells.select("plate", F.concat("row", F.lpad((F.col("col") + 1).cast("string"), 2, "0")).alias("well")).distinct()
    return metadata.layout(sheet, columns).join(present, ["plate", "well"], "left_semi")


@query("W14_plate_of_row", "SELECT image, last_value(CASE WHEN image % 5 = 0 THEN plate_name END IGNORE NULLS) OVER (PARTITION BY plate ORDER BY image ROWS UNBOUNDED PRECEDING) plate FROM images")
def w14(t: Tables):
    sheet = t.images.select(F.col("plate").alias("sheet"), "image", F.when(F.col("image") % 5 == 0, F.col("plate_name")).alias("marker"))
    return metadata.carry_plate(sheet, ["image"]).select("image", "plate")


@query("S8_read_lab_results", "SELECT cohort_id, price FROM (SELECT upper(priority) || well % 50 cohort_id, price, row_number() OVER (PARTITION BY priority, well % 50 ORDER BY image) n FROM images) WHERE n = 1")
def s8(t: Tables):
    """Results in a file of text columns, typed when it is read."""
    path = shared_folder(t.spark)
    sinks.export_flat(t.images.select(F.concat(F.upper("priority"), (F.col("well") % 50).cast("string")).alias("cohort_id"), "price", "image"), path)
    return metadata.first_results(readers.csv_folder(t.spark, path, "cohort_id string, price double, image long"), ["image"]).drop("image")


@query("S3_read_table_infer", "SELECT image, price, priority FROM images")
def s3(t: Tables):
    text = t.images.select(F.col("image").cast("string").alias("image"), F.col("price").cast("decimal(18,2)").cast("string").alias("price"), "priority")
    return readers.typed(text)


def files_of(t: Tables, docs):
    """The documents of rows (plate, json) written as a file each, and read from there."""
    path = shared_folder(t.spark)
    docs.repartition("plate").write.partitionBy("plate").text(path)
    return readers.settings(t.spark, path).withColumn("plate", F.col("plate").cast("long"))


@query("S4_read_channel_mapping", "SELECT DISTINCT plate, unnest(['DAPI', 'TRITC']) hardware, unnest(['nuclei', 'serum_' || plate]) semantic FROM images")
def s4(t: Tables):
    doc = t.images.select("plate").distinct().withColumn("json", F.concat(F.lit('{"DAPI": "nuclei", "WF_GFP": null, "TRITC": "serum_'), F.col("plate"), F.lit('"}')))
    return readers.channel_mapping(files_of(t, doc)).drop("file")


@query("P24_remap_channels", "SELECT plate, serum, CASE WHEN serum = 'serum_IgG' THEN 'serum_IgG' END gfp, CASE WHEN serum = 'serum_IgA' THEN 'serum_IgA' END tritc, 'nuclei' dapi FROM (SELECT DISTINCT plate FROM images), (SELECT unnest(['serum_IgG', 'serum_IgA']) serum)")
def p24(t: Tables):
    doc = F.lit('{"DAPI": "nuclei", "WF_GFP": "serum_IgG", "TRITC": "serum_IgA"}')
    rows = readers.channel_mapping(files_of(t, t.images.select("plate").distinct().withColumn("json", doc)))
    one = metadata.one_mapping_each(rows.groupBy("plate").agg(F.map_from_entries(F.collect_list(F.struct("hardware", "semantic"))).alias("mapping")))
    return one.select("plate", "serum", F.col("mapping.WF_GFP").alias("gfp"), F.col("mapping.TRITC").alias("tritc"), F.col("mapping.DAPI").alias("dapi"))


@query("S6_read_bg_wells", "SELECT DISTINCT plate, CASE plate % 3 WHEN 0 THEN 'wells' WHEN 1 THEN 'min' ELSE 'fixed' END mode, CASE WHEN plate % 3 = 0 THEN 'H01,G0' || plate % 10 END wells, CASE WHEN plate % 3 = 2 THEN plate * 1.5::DOUBLE END fixed_igg FROM images")
def s6(t: Tables):
    doc = F.when(F.col("plate") % 3 == 0, F.concat(F.lit('["H01", "G0'), F.col("plate") % 10, F.lit('"]'))).when(F.col("plate") % 3 == 1, F.lit('"min"')).otherwise(F.concat(F.lit('{"IgG": '), F.col("plate") * 1.5, F.lit("}")))
    mode, wells, fixed = readers.background_setting(F.col("json"))
    return files_of(t, t.images.select("plate").distinct().withColumn("json", doc)).select("plate", mode.alias("mode"), wells.alias("wells"), fixed["IgG"].alias("fixed_igg"))


@query("S9_read_plate_corrector", "SELECT image, CASE WHEN plate % 5 = 0 THEN 'plate_' || plate ELSE 'shape_' || well % 3 END corrector FROM images")
def s9(t: Tables):
    own = t.images.select("image", "plate", (F.col("well") % 3).alias("height"), F.lit(1).alias("width"))
    by_plate = t.images.where("plate % 5 = 0").select("plate").distinct().select("plate", F.lit(None).cast("long").alias("height"), F.lit(None).cast("int").alias("width"), F.concat(F.lit("plate_"), "plate").alias("corrector"))
    by_shape = own.select("height", "width").distinct().select(F.lit(None).cast("long").alias("plate"), "height", "width", F.concat(F.lit("shape_"), "height").alias("corrector"))
    path = shared_folder(t.spark)
    by_plate.unionByName(by_shape).write.option("header", True).csv(path)
    table = readers.csv_folder(t.spark, path, "plate long, height long, width int, corrector string")
    return readers.correctors(own, table).select("image", "corrector")


@query("S12_cohort_descriptions", "SELECT plate, well, letter, 'cohort ' || lower(letter) description FROM classes WHERE letter IS NOT NULL", PEOPLE)
def s12(t: Tables):
    described = people(t).where("cohort is not null").select(F.col("cohort").alias("letter")).distinct()
    doc = described.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("letter", F.concat(F.lit("cohort "), F.lower("letter")))))).alias("json"))
    table = metadata.explode_json_map(doc, "json").toDF("letter", "description")
    return people(t).select("plate", "well", F.col("cohort").alias("letter")).join(table, "letter")


@query("J12_score_metadata_join", f"SELECT c.plate, c.well, c.cohort_id, c.letter cohort, c.cohort_type, n, igg FROM classes c JOIN (SELECT plate, well, count(*) n FROM images GROUP BY ALL) USING (plate, well) LEFT JOIN lab l ON lower(c.cohort_id) = l.id", PEOPLE + ", lab AS (SELECT lower(cohort_id) id, min(well) / 4 igg FROM classes WHERE well % 3 = 0 GROUP BY lower(cohort_id))")
def j12(t: Tables):
    wells = t.images.groupBy("plate", "well").agg(F.count("*").alias("n"))
    lab = people(t).where("well % 3 = 0").groupBy(F.lower("cohort_id").alias("cohort_id")).agg((F.min("well") / 4).alias("igg"))
    return metadata.with_metadata(wells, people(t).select("plate", "well", "cohort_id"), lab)


@query("J13_enrich_wells", "SELECT well, CASE WHEN well % 4 = 0 THEN 'new' WHEN well % 4 = 1 THEN 'old' ELSE 'old' END kind, (well % 4 = 0) changed FROM (SELECT DISTINCT well FROM images)")
def j13(t: Tables):
    old = t.images.select("well").distinct().withColumn("kind", F.lit("old"))
    new = old.where("well % 4 < 2").select("well", F.when(F.col("well") % 4 == 0, "new").otherwise("old").alias("kind"))
    return metadata.enriched(old, new, ["well"], ["kind"])


@query("J14_build_plate_doc", "SELECT plate, to_json(list({'well': well, 'images': images} ORDER BY well))::VARCHAR wells FROM (SELECT plate, well, list({'image': image, 'is_outlier': is_outlier::INT} ORDER BY image) images FROM images JOIN flags USING (image) GROUP BY ALL) GROUP BY plate")
def j14(t: Tables):
    return metadata.plate_documents(t.images.select("plate", "well", "image").join(t.flags, "image").select("plate", "well", "image", "is_outlier"))


@query("J18_grid_cross", "SELECT plate, threshold, radius, count(*) n FROM images, (SELECT unnest([1.0, 2.0]::DOUBLE[]) threshold), (SELECT unnest([5, 10]::BIGINT[]) radius) GROUP BY ALL")
def j18(t: Tables):
    return Grid(threshold=[1.0, 2.0], radius=[5, 10]).points(t.images).groupBy("plate", "threshold", "radius").agg(F.count("*").alias("n"))


@query("J20_anti_missing", "SELECT DISTINCT plate, well FROM images WHERE well NOT IN (SELECT well FROM images WHERE image % 7 = 0)")
def j20(t: Tables):
    return levels.missing(t.images, t.images.where("image % 7 = 0"), ["plate", "well"])


@query("J21_status_semi", "SELECT DISTINCT plate FROM images WHERE plate IN (SELECT plate FROM images WHERE well % 100 = 7)")
def j21(t: Tables):
    return reports.with_status(t.images, t.images, "plate", F.col("well") % 100 == 7)


@query("A32_bg_well_audit", f"SELECT plate, {r('avg(CASE WHEN spot = ' + chr(39) + 'H01' + chr(39) + ' OR (plate % 4 IN (1, 2) OR plate % 4 = 0 AND plate >= 22) AND spot = ' + chr(39) + 'G01' + chr(39) + ' THEN 0 ELSE 1 END)', 'disagreement')} FROM images GROUP BY plate")
def a32(t: Tables):
    agree = F.array_contains(names.empty_wells(F.col("plate_name")), names.well_name(F.col("image_name")))
    return t.images.groupBy("plate").agg(F.avg((~agree).cast("int")).alias("disagreement"))


@query("T1_sort_names", "SELECT image_name, count(*) n FROM images GROUP BY image_name ORDER BY image_name")
def t1(t: Tables):
    return reports.sorted_names(t.images, "image_name")


IMAGE_N = "counted AS (SELECT plate, image, count(*) FILTER (WHERE is_infected = 1) i, count(*) FILTER (WHERE is_control = 1) c FROM classified GROUP BY ALL)"


def balance(t: Tables):
    counted = t.classified.groupBy("plate", "image").agg(F.count_if(F.col("is_infected") == 1).alias("n_infected"), F.count_if(F.col("is_control") == 1).alias("n_control"))
    skip = t.flags.where("is_outlier = 1").select("image").union(t.images.where("image % 9 = 0").select("image"))
    return evaluate.rank_by_balance(counted, skip).join(t.images.select("image", "plate"), "image")


@query("T2_rank_by_balance", f"SELECT plate, image, {r('abs(1 - i::DOUBLE / c)', 'balance')} FROM counted WHERE i > 0 AND c > 0 AND image % 9 <> 0 AND image NOT IN (SELECT image FROM flags WHERE is_outlier = 1)", IMAGE_N)
def t2(t: Tables):
    return balance(t)


@query("W12_round_robin_pick", f"SELECT plate, image, {r('b', 'balance')}, turn FROM (SELECT plate, image, abs(1 - i::DOUBLE / c) b, row_number() OVER (PARTITION BY plate ORDER BY abs(1 - i::DOUBLE / c), image) turn FROM counted WHERE i > 0 AND c > 0 AND image % 9 <> 0 AND image NOT IN (SELECT image FROM flags WHERE is_outlier = 1)) ORDER BY turn, plate LIMIT 60", IMAGE_N)
def w12(t: Tables):
    return evaluate.round_robin(balance(t), "plate", ["balance", "image"], 60)


@query("T4_annotation_list", "SELECT DISTINCT regexp_replace(plate_name, '_[0-9]{4}$', '') plate_name, image_name FROM images WHERE image % 4 <> 0")
def t4(t: Tables):
    return reports.annotation_list(t.images, t.images.where("image % 4 = 0"), "image")


@query("T3_topk_family", "SELECT plate, max_by(image, (price, image)) best, min_by(image, (price, image)) worst FROM images GROUP BY plate")
def t3(t: Tables):
    return reports.extremes(t.images, ["plate"], "image", "price")


@query("U3_common_labels", "SELECT DISTINCT label_id::BIGINT label_id FROM cells WHERE plate = 1 AND label_id <> 0 INTERSECT SELECT label_id FROM cells WHERE plate = 2")
def u3(t: Tables):
    labels = lambda p: t.cells.where(f"plate = {p}").select("label_id")
    return labels(1).intersect(labels(2)).where("label_id <> 0")


@query("U4_difference", "SELECT well FROM images EXCEPT SELECT well FROM images WHERE plate % 2 = 0")
def u4(t: Tables):
    return reports.difference(t.images, t.images.where("plate % 2 = 0"), "well")


@query("U5_rerun_set", "SELECT image FROM images WHERE image % 3 = 0 UNION SELECT image FROM images WHERE image % 5 = 0")
def u5(t: Tables):
    return reports.rerun_set(t.images.where("image % 3 = 0").select("image"), t.images.where("image % 5 = 0").select("image"))


@query("U6_same_keys", "SELECT DISTINCT image, CASE WHEN image % 2 = 0 THEN 'right' ELSE 'left' END missing_in FROM images WHERE image % 6 IN (2, 3, 4)")
def u6(t: Tables):
    return levels.same_keys(t.images.where("image % 2 = 0"), t.images.where("image % 3 = 0"), ["image"])


@query("K6_upsert_results", "SELECT well, plate, arg_max(price, (\"day\", image)) price, max(\"day\") \"day\" FROM images GROUP BY well, plate")
def k6(t: Tables):
    rows = t.images.select("well", "plate", "price", "day", "image")
    return sinks.upsert(rows.where("image % 2 = 0"), rows.where("image % 2 = 1"), ["well", "plate"], ["day", "image"]).drop("image")


@query("K7_doc_table", "SELECT plate, to_json(list({'well': well, 'n_cells': n} ORDER BY well))::VARCHAR \"rows\" FROM (SELECT plate, well, count(*) n FROM images GROUP BY ALL) GROUP BY plate")
def k7(t: Tables):
    table = t.images.groupBy("plate", "well").agg(F.count("*").alias("n.cells"))
    return metadata.document_rows(table, ["plate"])


@query("K9_plate_summary", "SELECT plate, unnest(['IgG', 'IgA']) channel, n_images, CASE WHEN plate % 3 = 0 THEN 'fixed 300.5' ELSE 'plate/backgrounds' END source, 'plate ' || plate || ': ' || n_images || ' images' message FROM (SELECT plate, count(*) n_images FROM images GROUP BY plate)")
def k9(t: Tables):
    return reports.plate_summaries(t.images, ["IgG", "IgA"], F.when(F.col("plate") % 3 == 0, F.lit("300.5")))


@query("K11_submission_manifest", "SELECT image_name file, letter cohort, CASE WHEN substr(plate_name, 6, 1) = 'U' THEN 'second serum' ELSE 'serum' END comment FROM images JOIN people USING (plate, well) UNION ALL SELECT DISTINCT 'plate_' || plate || '.csv', NULL, 'plate table' FROM images", PEOPLE)
def k11(t: Tables):
    return reports.submission_manifest(t.images.join(people(t), ["plate", "well"]))


@query("K12_table_alias", "SELECT image, count(*) n FROM classified GROUP BY image")
def k12(t: Tables):
    return t.spark.table(reports.aliased(t.classified.groupBy("image").agg(F.count("*").alias("n")), "cell_classification"))


@query("I1_incremental_inputs", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND event_id % 10 = 0) OR user_id IN (SELECT user_id FROM events WHERE \"value\" > 95 AND event_id % 10 = 1)")
def i1(t: Tables):
    e = t.read("events")
    return incremental.todo(e, e.where("event_type = 'error' and event_id % 10 = 0"), e.where("value > 95 and event_id % 10 = 1"), "user_id")


@query("I2_validate", "SELECT event_id, concat_ws(',', CASE WHEN NOT \"value\" < 90 THEN 'high' END, CASE WHEN NOT user_id > 10 THEN 'user' END) problems FROM events")
def i2(t: Tables):
    return incremental.validated(t.read("events"), {"high": F.col("value") < 90, "user": F.col("user_id") > 10}).select("event_id", "problems")


LOG = "log AS (SELECT user_id plate, event_type job, CASE WHEN \"value\" > 20 THEN 'processed' ELSE 'failed' END state, event_id AS seen FROM events), last AS (SELECT plate, job, arg_max(state, seen) state FROM log GROUP BY ALL)"


def run_log(t: Tables):
    return t.read("events").select(F.col("user_id").alias("plate"), F.col("event_type").alias("job"), F.when(F.col("value") > 20, "processed").otherwise("failed").alias("state"), F.col("event_id").alias("at"))


@query("I3_run_log", "SELECT plate, job, state FROM last", LOG)
def i3(t: Tables):
    return incremental.states(run_log(t)).drop("at")


@query("I4_skip_processed", "SELECT plate, job FROM last WHERE state <> 'processed'", LOG)
def i4(t: Tables):
    return incremental.unprocessed(run_log(t).select("plate", "job").distinct(), run_log(t))


@query("I5_upsert", "SELECT user_id, arg_max(\"value\", (ts, event_id)) \"value\" FROM events GROUP BY user_id")
def i5(t: Tables):
    e = t.read("events").select("user_id", "value", "ts", "event_id")
    once = sinks.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id"], ["ts", "event_id"])
    return sinks.upsert(once, e.where("event_id % 2 = 1"), ["user_id"], ["ts", "event_id"]).select("user_id", "value")


@query("I6_version_stamp", "SELECT event_id, '1.0' version FROM events")
def i6(t: Tables):
    return incremental.stamped(t.read("events").select("event_id"), "1.0")


@query("S5_read_manual_tags", "SELECT CASE WHEN image % 4 = 1 THEN 'one' ELSE 'three' END plate, image_name || image image, tag::BIGINT tag FROM images JOIN tags USING (image)")
def s5(t: Tables):
    """Taggers' files of two plates, read and checked."""
    path = shared_folder(t.spark)
    rows = t.images.join(t.tags, "image").select("image", F.concat(F.lit("/a/"), "image_name", F.col("image").cast("string"), F.lit(".h5")).alias("filename"), F.col("tag").alias("label"))
    for plate, rest in (("one", 1), ("three", 3)):
        rows.where(F.col("image") % 4 == rest).select("filename", "label").write.option("header", True).csv(f"{path}/{plate}_tagger_state.csv")
    read = readers.manual_tags(t.spark, path)
    return qc.manual_tags(read.select(F.struct("plate", "image").alias("image"), "tag")).select("image.plate", "image.image", "tag")


@query("S1_scan_images", "SELECT 'orders' stem, count(*) n FROM orders")
def s1(t: Tables):
    rows = readers.images(t.spark, t.dir, "orders.parquet")
    return rows.groupBy(names.file_stem(F.col("file")).alias("stem")).agg(F.count("*").alias("n"))
