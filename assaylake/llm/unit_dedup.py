"""Removal of repeated text units by hashing.

A unit is a sentence within a line: it ends with a line feed, or with a run of ``.!?`` before white space. Units
are normalised (lower case, single spaces) and hashed; digests are grouped over all documents; the occurrence of
the least rank (document id, then place) stays and every other one is reported with its offsets in the text, the words
of the repeated units around it that follow each other, and whether all of its text repeats.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import saved
from .text import slices

SPACE = r"[\x20\x09-\x0D]"
#: Units follow each other without gaps, so their lengths add up to offsets.
UNIT = r"(?:[^.!?\n]|[.!?]+[^.!?\x20\x09-\x0D])*(?:[.!?]+[\x20\x09-\x0D]*|\n|$)"
#: Words of a passage: what the op2 query asks of repeated units that follow each other. Units of fewer words than
#: ``SENTENCE`` repeat by chance: they neither end a run of repeated units nor count for its length.
PASSAGE, SENTENCE = 20, 4
#: Copies that the one row of a digest is dealt to, so that a digest in a third of all rows meets in no one task.
SALT = 8

ASCII_SPACE = dict.fromkeys([*range(9, 14)], " ")


def units(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(number, start, end, normalised unit) of a text's units."""
    for number, found in enumerate(re.finditer(UNIT, text)):
        if found.end() > found.start():
            yield number, found.start(), found.end(), " ".join(x for x in found.group().lower().translate(ASCII_SPACE).split(" ") if x)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        columns: list[list] = [[] for _ in range(11)]
        for doc, t, text in zip(*(piece.column(k).to_pylist() for k in ("doc_id", "t", "text"))):
            seen, seq, before = set(), 0, len(columns[0])
            for number, start, end, plain in units(text):
                if plain:
                    n = plain.count(" ") + 1
                    seq += n >= SENTENCE
                    digest = xxhash.xxh3_128_intdigest(plain)
                    again = digest in seen
                    seen.add(digest)
                    for column, value in zip(columns, (doc, t, number, seq, start, end, n, again, (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63))):
                        column.append(value)
            columns[10] += [len(columns[0]) - before] * (len(columns[0]) - before)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:2]), *(pa.array(c, pa.int32()) for c in columns[2:7]), pa.array(columns[7], pa.bool_()), *(pa.array(c, pa.int64()) for c in columns[8:10]), pa.array(columns[10], pa.int32())], ["doc_id", "t", "unit_no", "seq", "start", "end", "n_words", "again", "h1", "h2", "n_units"])


def repeated_units(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_run: int = 0) -> DataFrame:
    """One row for each unit of one word or more that is not the first of its kind: doc_id, t (the text's hash), unit_no,
    start, end (code points), n_words, kept_doc_id (the document in which the unit stays, at its first place), run_words
    (words of the sentences among the repeated units that follow each other there) and whole (all units of the text repeat, as those of an
    exact copy do).

    With ``least_run``, only those in passages of so many words or in texts that repeat as a whole. Null and empty texts
    have no units. A null id ranks after all others. Rows that repeat an id have equal ranks: where they hold the first
    occurrence, it stays in each. An empty table gives no rows; other columns are not looked at.
    """
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    # digested once: the table is read for the first occurrences and for the others
    rows = saved(whole.mapInArrow(_digests, "doc_id long, t long, unit_no int, seq int, start int, end int, n_words int, again boolean, h1 long, h2 long, n_units int"))
    last = F.lit(2**63 - 1)
    first = rows.groupBy("h1", "h2").agg(F.min(F.coalesce("doc_id", last)).alias("kept"), F.count("*").alias("times")).where("times > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    first = first.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "kept", salts.alias("k3"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "unit_no"), F.lit(SALT)).cast("int"))
    met = salted.join(first, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("salt") == F.col("k3")))
    gone = met.where(F.col("again") | (F.coalesce("doc_id", last) != F.col("kept")))
    # rows equal in id and text are counted before they meet, and told out again at the end
    gone = gone.groupBy("doc_id", "t", "unit_no", "seq", "start", "end", "n_words", "n_units", "kept").agg(F.count("*").cast("int").alias("copies"))
    row = ["doc_id", "t"]
    # seq counts sentences, so a run is told by the sentences before it that do not repeat
    sentence = F.col("n_words") >= SENTENCE
    gone = gone.withColumn("run", F.col("seq") - F.sum(sentence.cast("int")).over(Window.partitionBy(*row).orderBy("unit_no")))
    gone = gone.withColumn("run_words", F.sum(F.when(sentence, F.col("n_words")).otherwise(0)).over(Window.partitionBy(*row, "run")))
    gone = gone.withColumn("whole", F.count("*").over(Window.partitionBy(*row)) == F.col("n_units"))
    if least_run:
        gone = gone.where(F.col("whole") | (F.col("run_words") >= least_run))
    kept = F.when(F.col("kept") < last, F.col("kept")).alias("kept_doc_id")
    return gone.select("doc_id", "t", "unit_no", "start", "end", "n_words", kept, "run_words", "whole", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


def strip_units(docs: DataFrame, removed: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the units of ``removed`` (doc_id, t, start, end) cut out of the texts that they were found in, all other
    columns as they were. Rows of one id and different texts each lose their own units."""
    spans = removed.groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for body, cuts in zip(texts, spans):
            if body is not None and cuts is not None:
                at, kept = 0, []
                for span in cuts:
                    kept.append(body[at : span["start"]])
                    at = span["end"]
                body = "".join([*kept, body[at:]])
            out.append(body)
        return pd.Series(out)

    joined = docs.join(spans, F.col("_id").eqNullSafe(docs[doc_id]) & (F.col("_t") == F.xxhash64(docs[text])), "left")
    return joined.withColumn(text, cut(F.col(text), F.col("_spans"))).drop("_id", "_t", "_spans")
