"""Plate layouts, cohorts, lab tests and nested plate documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names


def carry_plate(sheet: DataFrame, order: list[str], marker: str = "marker") -> DataFrame:
    """Each row with the last plate marker at or above it within its sheet."""
    upto = Window.partitionBy("sheet").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sheet.withColumn("plate", F.last(marker, ignorenulls=True).over(upto))


#: Letters of a plate's rows, its columns, and what a cell that begins a plate's block has.
ROWS, COLUMNS, MARKER = "ABCDEFGH", 12, "Plate "


def sheet_blocks(rows: DataFrame) -> DataFrame:
    """Rows (file, sheet, row_no, cells) with block and marker: a row with a plate's name in any cell begins a block that
    reaches to the next; rows before the first are in block 0, without a marker."""
    named = F.get(F.filter("cells", lambda c: c.contains(MARKER)), 0)
    upto = Window.partitionBy("file", "sheet").orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = rows.withColumn("_m", F.trim(named))
    return begun.withColumn("block", F.count("_m").over(upto)).withColumn("marker", F.last("_m", ignorenulls=True).over(upto)).withColumn("begins", F.col("_m").isNotNull()).drop("_m")


def well_cells(rows: DataFrame) -> DataFrame:
    """``rows`` with well and cohort_id: a row with a letter A to H in some cell has the wells of that letter in the cells
    after the first such one, twelve at most, whatever columns come before. Cells that are no cohort id are unknown."""
    letters = F.transform("cells", lambda c: F.coalesce(c.isin(list(ROWS)), F.lit(False)))
    at = F.array_position(letters, True).cast("int")
    own = rows.withColumn("_at", at).where(F.col("_at") > 0)
    opened = own.select("*", F.get("cells", F.col("_at") - 1).alias("_l"), F.posexplode(F.slice("cells", F.col("_at") + 1, F.lit(COLUMNS))).alias("_p", "_c"))
    well = F.concat("_l", F.lpad((F.col("_p") + 1).cast("string"), 2, "0"))
    return opened.withColumn("well", well).withColumn("cohort_id", names.clean_cohort_id(F.coalesce("_c", F.lit("nan")))).drop("_at", "_l", "_p", "_c")


def sheet_layout(rows: DataFrame, plates: dict[str, list[str]] | None = None) -> DataFrame:
    """plate, well, cohort_id of sheets with several plates, from rows (file, sheet, row_no, cells: array of strings).

    A block may hold for several plates: ``plates`` has those of a marker; a marker that isn't there is the plate's name
    itself. Of a plate's blocks the last one counts, by file, sheet and row, and of a well's cells in it the last; a
    block without wells also takes the place of those before it. Rows before the first marker of a sheet are nobody's.
    Null and empty cells are unknown cohorts; an empty table gives no rows.
    """
    blocks = sheet_blocks(rows)
    where = ["file", "sheet", "block"]
    known = F.create_map(*[x for k, v in (plates or {}).items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) if plates else None
    named = F.coalesce(known[F.col("marker")], F.array("marker")) if plates else F.array("marker")
    held = blocks.where("begins").select(*where, F.explode(named).alias("plate"))
    last = held.groupBy("plate").agg(F.max(F.struct(*where)).alias("b")).select("plate", "b.*")
    cells = well_cells(blocks.where("not begins and block > 0"))
    own = last.join(cells, where)
    return own.groupBy("plate", "well").agg(F.max_by("cohort_id", "row_no").alias("cohort_id"))


def single_plate_layout(rows: DataFrame, suffix: str = "_final") -> DataFrame:
    """plate, well, cohort_id of files with one plate, named ``<plate><suffix>``: the last cell of a well counts."""
    cells = well_cells(rows.where(F.col("file").contains(suffix)))
    plate = F.substring_index(F.col("file"), suffix, 1)
    return cells.groupBy(plate.alias("plate"), "well").agg(F.max_by("cohort_id", F.struct("sheet", "row_no")).alias("cohort_id"))


def layout(grid: DataFrame, columns: list[str]) -> DataFrame:
    """plate, well, cohort_id from layout rows (plate, row letter, one column a plate column)."""
    cells = grid.select("plate", "row", F.posexplode(F.array(*columns)).alias("pos", "cell"))
    return cells.select("plate", F.concat("row", F.lpad((F.col("pos") + 1).cast("string"), 2, "0")).alias("well"), names.clean_cohort_id(F.col("cell")).alias("cohort_id"))


def first_results(results: DataFrame, order: list[str]) -> DataFrame:
    """One row a cohort id (upper or lower case), the first in sheet order."""
    rank = F.row_number().over(Window.partitionBy(F.lower("cohort_id")).orderBy(*order))
    return results.withColumn("_r", rank).where("_r = 1").drop("_r")


def with_metadata(wells: DataFrame, layouts: DataFrame, results: DataFrame) -> DataFrame:
    """Wells with cohort id, cohort, class, and lab tests by cohort id in either case."""
    known = wells.join(layouts, ["plate", "well"], "left")
    known = known.withColumn("cohort", names.cohort_letter(F.col("cohort_id"))).withColumn("cohort_type", names.cohort_class(F.col("cohort")))
    tests = results.select(F.lower("cohort_id").alias("_c"), *[c for c in results.columns if c != "cohort_id"])
    return known.join(tests, F.lower("cohort_id") == F.col("_c"), "left").drop("_c")


def enriched(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``old`` with values taken over from ``new`` where that has them, and changed: whether any differs."""
    other = new.select(*keys, *[F.col(v).alias(f"_n_{v}") for v in values])
    both = old.join(other, keys, "left")
    changed = F.lit(False)
    for v in values:
        changed = changed | ~F.coalesce(f"_n_{v}", v).eqNullSafe(F.col(v))
    both = both.withColumn("changed", changed)
    return both.withColumns({v: F.coalesce(f"_n_{v}", v) for v in values}).drop(*[f"_n_{v}" for v in values])


def plate_documents(images: DataFrame) -> DataFrame:
    """plate, wells: an array of wells with their images, from rows (plate, well, image, is_outlier). Two aggregates; a
    document is a plate's, which has 96 wells."""
    wells = images.groupBy("plate", "well").agg(F.sort_array(F.collect_list(F.struct("image", "is_outlier"))).alias("images"))
    return wells.groupBy("plate").agg(F.sort_array(F.collect_list(F.struct("well", "images"))).alias("wells"))


def document_rows(table: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rows: the other columns as an array of structs, dots in names as underscores."""
    rest = [F.col(f"`{c}`").alias(c.replace(".", "_")) for c in table.columns if c not in keys]
    return table.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("rows"))


def wells_of_type(wells: DataFrame, kinds: list[str]) -> DataFrame:
    """Distinct (plate, well) whose class is one of the kinds."""
    return wells.where(F.col("cohort_type").isin(kinds)).select("plate", "well").distinct()


def explode_json_map(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """A JSON object of strings as rows key, value; null values are dropped by the reader's caller if unwanted."""
    return df.select(*keep, F.explode(F.from_json(column, "map<string,string>")).alias("key", "value"))


def one_mapping_each(mappings: DataFrame) -> DataFrame:
    """A channel mapping of several sera as one mapping for each serum; other channels stay in each."""
    serum = lambda v: v.startswith("serum")
    sera = mappings.select("*", F.explode(F.array_distinct(F.filter(F.map_values("mapping"), lambda v: F.coalesce(serum(v), F.lit(False))))).alias("serum"))
    return sera.withColumn("mapping", F.transform_values("mapping", lambda _, v: F.when(serum(v) & (v != F.col("serum")), F.lit(None)).otherwise(v)))
