"""Mixing sources to target weights by hash-threshold histograms.

A document's place in its source is a hash of its id, so a budget is a threshold on the hash: the documents
below it are taken. Tokens are summed by source and the hash's leading digits; a running sum finds the bucket
in which each budget ends; only that bucket is summed again by the next digits. Nothing is sorted by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import saved

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST = 3
#: Hex digits of the hash that one histogram adds, and how many histograms there are.
DIGITS, LEVELS = 3, 3
#: Copies of a source's row that its documents are dealt to.
SALT = 32


def word_count(text: str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of each row (source, source_size): shares by weight of the sum of all sizes,
    held at ``MOST`` times the source's size, the excess shared again by weight until no source is above.

    That end state gives each free source ``level * weight`` with one level for all, so sources are held in the
    order of size to weight and the level is the first that the rest can bear. The rows are one a source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("most", (F.col("source_size") * MOST).cast("double"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    # the level rises while sources that it would overfill are held and falls once others are, so the highest is it
    return rows.withColumn("level", (total.cast("double") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(rest)).withColumn("level", F.max("level").over(Window.partitionBy())).select("source", "source_size", F.least(F.col("most"), F.col("level") * F.col("weight")).alias("target"))


def place(doc_id: str) -> Column:
    """The hash that orders the documents of a source."""
    return F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, DIGITS * LEVELS)


def budgets(base: DataFrame) -> DataFrame:
    """source, source_size, target, copies, last, take_last of each source of rows (doc_id, source, size, place): whole
    copies of the source, and the place up to which documents are taken once more."""
    goal = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = saved(goal.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("prefix", F.lit("")).withColumn("below", F.lit(0).cast("long")))
    edge = goal.select("source", "budget", "prefix", "below")
    for level in range(1, LEVELS + 1):
        here = F.col("s").eqNullSafe(F.col("source")) & (F.col("salt") == F.pmod(F.xxhash64("doc_id"), F.lit(SALT))) & F.col("place").startswith(F.col("prefix"))
        inside = base.join(salted(edge).withColumnRenamed("source", "s"), here)
        sums = inside.groupBy("source", "budget", "below", F.substring("place", 1, DIGITS * level).alias("bucket")).agg(F.sum("size").alias("tokens"))
        upto = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.col("below") + F.sum("tokens").over(upto))
        # the boundary bucket: the first whose end passes the budget; without one, all of the source is below
        first = Window.partitionBy("source").orderBy("bucket")
        over = sums.where(F.col("upto") > F.col("budget")).withColumn("n", F.row_number().over(first)).where("n = 1")
        if level < LEVELS:
            edge = saved(over.select("source", "budget", F.col("bucket").alias("prefix"), (F.col("upto") - F.col("tokens")).alias("below")))
        else:  # the last bucket is taken if that comes nearer to the budget
            nearer = F.col("upto") - F.col("budget") <= F.col("budget") - (F.col("upto") - F.col("tokens"))
            edge = over.select(F.col("source").alias("s"), F.col("bucket").alias("last"), nearer.alias("take_last"))
    plan = goal.select("source", "source_size", "target", "copies").join(edge, F.col("s").eqNullSafe(F.col("source")), "left").drop("s")
    return saved(plan)


def copies() -> Column:
    """How often a row of (place, copies, last, take_last) is taken: under the threshold once more."""
    more = (F.col("place") < F.col("last")) | ((F.col("place") == F.col("last")) & F.col("take_last"))
    return F.col("copies") + F.when(more, 1).otherwise(0)


def salted(plan: DataFrame) -> DataFrame:
    """The rows of ``plan`` once for each salt, so that the rows of a hot source meet in many tasks."""
    return plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken of each row.

    A source whose target holds its size c whole times is taken c times, and the documents under its threshold
    once more. A null text has size 0, a null source is a source of its own, null ids share one hash; rows of
    one id are taken or left together. An empty table gives no rows. Other columns are not looked at.
    """
    base = saved(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), place(doc_id).alias("place")))
    plan = salted(budgets(base)).withColumnRenamed("source", "g")
    match = F.col("g").eqNullSafe(F.col("source")) & (F.col("salt") == F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
    return base.join(plan, match).select("doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def repeat_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them; rows without words stay once."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    marked = docs.select(row, docs[doc_id].alias("doc_id"), docs[source].alias("of"), word_count(text).alias("size"), place(doc_id).alias("place"))
    plan = salted(budgets(saved(marked.select("doc_id", F.col("of").alias("source"), "size", "place"))))
    joined = marked.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.pmod(F.xxhash64(marked["doc_id"]), F.lit(SALT))))
    times = F.when(F.col("size") > 0, copies()).otherwise(F.lit(1)).cast("int")
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
