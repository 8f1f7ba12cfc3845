"""The queries of this subpackage, by the names that the driver calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, hamming_topk, jaccard_trees, language_id, mixing, oracles, packing, repetition, secrets, spelling_variants, token_counts, toxicity, unit_dedup, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_topk.nearest_vectors(table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents"), least_run=unit_dedup.PASSAGE).drop("t")


def op2_substring_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_units(table(spark, sf_dir, "documents")).drop("t")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_trees.jaccard_components(table(spark, sf_dir, "documents")).drop("root", "t")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents")).drop("accepted")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_url_filters_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules alone say of each page."""
    return url_filter.by_rules(table(spark, sf_dir, "pages")).drop("plain")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


def op7_quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of each document."""
    return op7_quality_rules(spark, sf_dir).drop("kept", "covered", "longest_repeat")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op9_secret_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the patterns' findings in each document."""
    return op9_secret_scan(spark, sf_dir).drop("base_sha256", "spans")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in sorted(globals().items()) if k == "pipeline" or k.startswith("op") and k[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
