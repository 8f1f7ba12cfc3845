"""Stages that turn documents into a packed, mixed corpus. Each takes and returns the columns of documents, but for
the last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard_trees, language_id, mixing, packing, secrets

#: Near copies share so many percent of the shingles of so many words.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def keep_languages(docs: DataFrame) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.accepted_documents(docs)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies: those with a Jaccard of five-word shingles of 0.8 or more."""
    return jaccard_trees.one_of_each(docs, width=NEAR_SHINGLE, percent=NEAR_PERCENT)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All documents, secrets replaced by a mark, n_chars as the text has it then."""
    return secrets.redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def mix_sources(docs: DataFrame) -> DataFrame:
    """Documents as often as the mix takes them; a document of no words stays once."""
    return mixing.repeat_rows(docs)


def pack(docs: DataFrame) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs)
