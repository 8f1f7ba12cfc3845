"""Random forests on per-cell features, judged on plates that they haven't seen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .evaluate import confusion_of_counts

TREES, DEPTH = 150, 10
#: Folds at most: each has a model of its own.
MOST_FOLDS = 32
#: Bins of a feature, as many as a tree tells apart, and parts that rows of one point are drawn in, each with its share of the rows.
BINS, PARTS = 32, 4


def has_all(features: list[str]) -> Column:
    """Rows with a value of each feature, neither null nor NaN."""
    return reduce(lambda a, b: a & b, (F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in features))


def bins_of(cells: DataFrame, features: list[str]) -> Bucketizer:
    """Bins of the features, from all rows: a feature's values where they are ``BINS`` or fewer, else between approximate quantiles."""
    shares = [k / BINS for k in range(1, BINS)]
    rows = cells.select(*(F.col(f).cast("double").alias(f) for f in features))
    row = rows.agg(*(a for k, f in enumerate(features) for a in (F.percentile_approx(f, shares).alias(f"q{k}"), F.approx_count_distinct(f).alias(f"n{k}")))).first()
    few = [k for k in range(len(features)) if row[f"n{k}"] <= 2 * BINS]
    values = rows.agg(*(F.sort_array(F.collect_set(features[k])).alias(f"v{k}") for k in few)).first() if few else None
    splits = []
    for k in range(len(features)):
        own = values[f"v{k}"] if k in few else []
        cuts = sorted(set(own[1:] if 0 < len(own) <= BINS else row[f"q{k}"] or []))
        splits.append([-math.inf, *([c for c in cuts if math.isfinite(c)] or [0.0]), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=features, outputCols=[f"_bin_{f}" for f in features], handleInvalid="skip")


def counted(cells: DataFrame, bins: Bucketizer, by: list[str]) -> DataFrame:
    """by, bins, n: the points that cells are at, and how many are. Their number is bounded by the bins, whatever that of the cells is."""
    return bins.transform(cells).groupBy(*by, *bins.getOutputCols()).agg(F.count("*").alias("n"))


def forest_of(points: DataFrame, bins: Bucketizer, label: str, trees: int, depth: int) -> RandomForestClassificationModel:
    """A forest of counted points. Every row counts; a bootstrap draws the rows of a point one by one, or in ``PARTS`` equal parts
    where they are more."""
    parts = F.least("n", F.lit(PARTS))
    drawn = points.select("*", (F.col("n") / parts).alias("_weight"), F.explode(F.sequence(F.lit(1).cast("long"), parts)).alias("_part"))
    drawn = drawn.repartition(points.sparkSession.sparkContext.defaultParallelism)
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="_weight", maxBins=BINS, numTrees=trees, maxDepth=depth, seed=1)
    return forest.fit(assembler(bins).transform(drawn))


def assembler(bins: Bucketizer) -> PipelineModel:
    """Bins as features in their order: a sum has no metadata, by which a forest would take them for unordered categories."""
    names = bins.getOutputCols()
    plain = SQLTransformer(statement="SELECT *, " + ", ".join(f"`{c}` + 0D AS `_at{c}`" for c in names) + " FROM __THIS__")
    return PipelineModel([plain, VectorAssembler(inputCols=[f"_at{c}" for c in names], outputCol="features")])


def train_forest(cells: DataFrame, features: list[str], label: str, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    """A forest for ``label`` from cells that are no outliers (is_outlier = 1 is left out); rows with a null feature are neither
    trained on nor scored."""
    kept = cells.where("coalesce(is_outlier, 0) <> 1").where(has_all(features)).select(*features, label).persist()
    bins = bins_of(kept, features)
    points = counted(kept, bins, [label]).persist()
    model = forest_of(points, bins, label, trees, depth)
    for done in (points, kept):
        done.unpersist()
    return PipelineModel([bins, assembler(bins), model])


def fold_of(plate: str, folds: int) -> Column:
    """A fold for each plate, the same in every run: all cells of a plate are in one."""
    return F.pmod(F.xxhash64(plate), F.lit(folds)).cast("int")


def held_out_forest(cells: DataFrame, features: list[str], label: str, fold: Column, folds: int, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``cells`` with fold and prediction (0 or 1), each row by the forest that was trained without its fold.

    ``fold`` is from 0 to ``folds`` - 1 and should be one for a plate, so a forest is judged on plates that it hasn't seen; as many
    folds as plates leave one plate out each. Outliers are scored, but not trained on; rows with a null feature aren't
    scored, and fall out. A fold whose training rows are of one class, or none, gets that class (0 without rows).
    """
    if not 2 <= folds <= MOST_FOLDS:
        raise ValueError(f"folds are from 2 to {MOST_FOLDS}")
    own = cells.withColumn("fold", fold).where(has_all(features))
    used = own.select("fold", label, *features, (F.coalesce("is_outlier", F.lit(0)) != 1).alias("_used")).persist()
    bins = bins_of(used.where("_used"), features)
    points = counted(used, bins, ["fold", label, "_used"]).persist()
    counts = points.where("_used").groupBy("fold").agg(F.sum("n").alias("n"), F.sum(F.col(label) * F.col("n")).alias("ones")).collect()  # a row a fold
    used.unpersist()
    keys = ["fold", *bins.getOutputCols()]
    parts = []
    for k in range(folds):
        n, ones = (sum(r[c] or 0 for r in counts if r["fold"] != k) for c in ("n", "ones"))
        at = points.where(F.col("fold") == k).select(*keys).distinct()
        if 0 < ones < n:
            model = forest_of(points.where(F.col("_used") & (F.col("fold") != k)), bins, label, trees, depth)
            at = model.transform(assembler(bins).transform(at)).select(*keys, "prediction")
        else:
            at = at.withColumn("prediction", F.lit(float(bool(n) and ones == n)))
        parts.append(at)
    # cells of one point have one prediction, so forests are asked once for each
    told = reduce(lambda a, b: a.unionByName(b), parts).withColumn("prediction", F.col("prediction").cast("int"))
    return bins.transform(own).join(told, keys).select(*own.columns, "prediction")


def fold_confusion(predicted: DataFrame, label: str) -> DataFrame:
    """fold, and the confusion counts and scores of its held-out rows, with ``label`` 1 as positive."""
    counts = predicted.groupBy("fold", F.col("prediction").alias("is_control"), F.col(label).cast("int").alias("truth_control")).agg(F.count("*").alias("n"))
    return confusion_of_counts(counts, ["fold"])
