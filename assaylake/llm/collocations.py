"""Phrase collocations: phrases of several words that occur often, and more often than their parts would by chance.

Frequent phrases are found in two steps. Misra-Gries summaries of the phrases' hashes, one for each partition of the hashes,
are filled where the texts are read and merged; as a summary's capacity exceeds its partition's mass divided by the threshold,
it can't lose a frequent phrase. A second pass counts exactly what survived. A phrase is only summarised if its
words, and for longer ones its pairs of words, may be frequent: a phrase is never more frequent than a part of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import key_filter, passes
from .store import discard, saved
from .text import U64, mix, runs, slices, strings

#: ASCII characters between pieces, and between the words of a piece.
BREAKS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
LEAST, LONGEST, TOP = 100, 5, 2000
#: A candidate goes if a longer one that holds it has so many percent of its occurrences.
PERCENT = 100
NO_LANG = "und"
#: A summary has so many times the counters that it needs.
SLACK = 4
#: Counters of a partition of the hashes at most, on average, and partitions for each one of a shuffle.
COUNTERS, PARTS_EACH = 1 << 18, 8
#: Counters that a task holds before it hands them on.
HELD = 2 << 20
ODD = U64(0x9E3779B97F4A7C15)


def hashed(values: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(values, object), categorize=False).astype(U64)


class Words:
    """The words of some texts in order: their distinct words, and for each word its index there, its language's
    index, its hash with the language, and its piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        large = pa.large_string()
        ended = pc.binary_join_element_wise(pc.ascii_lower(texts).cast(large), pa.scalar("", large), pa.scalar("\n", large))
        offsets = np.frombuffer(ended.buffers()[1], np.int64)[: len(ended) + 1]
        data = np.frombuffer(ended.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        kinds = np.zeros(256, np.uint8)
        kinds[[ord(c) for c in BLANKS]], kinds[[ord(c) for c in BREAKS]] = 1, 2
        kind = kinds[data]
        inside = kind == 0
        starts, ends = runs(inside)
        bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        letters = data[inside]
        coded = pa.Array.from_buffers(large, len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
        self.names = strings(coded.dictionary)
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.cumsum(kind == 2)[starts]
        spoken = langs.dictionary_encode()
        self.langs = strings(spoken.dictionary)
        self.lang = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)[np.searchsorted(offsets, starts, side="right") - 1]
        self.hash = hashed(self.names)[self.word] if len(self.word) else np.zeros(0, U64)
        self.key = mix(self.hash * ODD + hashed(self.langs)[self.lang]) if len(self.word) else self.hash

    def __len__(self) -> int:
        return len(self.word)

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """(k, keys of the phrases of k words that begin at each word), for k of 2 and more; a phrase that leaves its piece
        has a key as well."""
        keys = self.key
        for k in range(2, min(longest, len(self)) + 1):
            keys = mix(keys[: len(self) - k + 1] * ODD + self.hash[k - 1 :])
            yield k, keys

    def in_piece(self, k: int) -> np.ndarray:
        return self.piece[: len(self) - k + 1] == self.piece[k - 1 :]

    def counted(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """lang, phrase, n of the phrases of k words at the positions ``at``; told apart by their words, not by hashes."""
        size = max(1, len(self.names))
        rank = np.unique(self.lang[at] * size + self.word[at], return_inverse=True)[1]
        for j in range(1, k):
            rank = np.unique(rank * size + self.word[at + j], return_inverse=True)[1]
        _, first, n = np.unique(rank, return_index=True, return_counts=True)
        begins = at[first]
        names = self.names
        said = [" ".join([names[w] for w in self.word[b : b + k].tolist()]) for b in begins.tolist()] if k > 1 else [names[w] for w in self.word[begins].tolist()]
        return pa.record_batch({"lang": pa.array([self.langs[x] for x in self.lang[begins].tolist()], pa.string()), "phrase": pa.array(said, pa.string()), "n": pa.array(n.astype(np.int64))})


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in slices(batches):
        yield Words(batch.column("text"), batch.column("lang"))


def _combined(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(n, first) if len(first) else n


class Summary:
    """A Misra-Gries summary: with ``capacity`` counters no count is more than mass / (capacity + 1) too low. Summaries are merged
    by adding their counters; then the counter after the last place is taken off all."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.waits = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.waits += len(keys)
        if self.waits > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys, counts = _combined([self.keys, *(k for k, _ in self.waiting)], [self.counts, *(n for _, n in self.waiting)])
        self.waiting, self.waits = [], 0
        if len(keys) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            keys, counts = keys[counts > off], counts[counts > off] - off
            self.taken += off
        self.keys, self.counts = keys, counts

    def frequent(self, least: int) -> np.ndarray:
        """All keys that may have a count of ``least``."""
        self.merge()
        return self.keys[self.counts + self.taken >= least]


def summarised(texts: DataFrame, lengths: range, unit: int, known: Broadcast, parts: int) -> DataFrame:
    """slot, key, n: counters of the hashes of phrases with so many words, of which all parts of ``unit`` words pass the filter
    ``known``. A slot is twice the partition of the hashes, and one more for counters; the other slot has masses."""

    def handed(held: list) -> Iterator[pa.RecordBatch]:
        keys, n = _combined([k for k, _ in held], [x for _, x in held])
        part = ((keys >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
        mass = np.bincount(part, n, parts).astype(np.int64)
        some = np.flatnonzero(mass)
        yield pa.record_batch({"slot": 2 * some, "key": np.zeros(len(some), np.int64), "n": mass[some]})
        for k in range(0, len(keys), 1 << 16):
            piece = slice(k, k + (1 << 16))
            yield pa.record_batch({"slot": 2 * part[piece] + 1, "key": keys[piece].view(np.int64), "n": n[piece]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for words in _read(batches):
            known_units = passes(known.value, words.key) if unit == 1 else None
            new = []
            for k, keys in words.phrases(lengths[-1]):
                if k == unit:
                    known_units = passes(known.value, keys) & words.in_piece(k)
                if k in lengths:
                    full = words.in_piece(k)
                    for j in range(k - unit + 1):
                        full &= known_units[j : j + len(full)]
                    new.append(keys[full])
            if new:
                keys, n = np.unique(np.concatenate(new), return_counts=True)
                held.append((keys, n.astype(np.int64)))
                size += len(keys)
            if size > HELD:
                held = [_combined([k for k, _ in held], [x for _, x in held])]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from handed(held)
                    held, size = [], 0
        if size:
            yield from handed(held)

    return texts.mapInArrow(run, "slot long, key long, n long")


def survivors(summaries: DataFrame, least: int, partitions: int) -> DataFrame:
    """key of everything in the merged summaries that may have ``least`` occurrences. A partition's masses are sorted
    before its counters, so its capacity is known when they are merged, and a task holds one summary at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = -1, 0, None
        done = lambda: pa.record_batch({"key": (summary.frequent(least) if summary else np.zeros(0, U64)).view(np.int64)})
        for batch in batches:
            slot, key, n = (batch.column(c).to_numpy() for c in ("slot", "key", "n"))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(slot)) + 1, [len(slot)]]) if len(slot) else []
            for a, b in zip(edges, edges[1:]):
                if slot[a] >> 1 != part:
                    yield done()
                    part, mass, summary = slot[a] >> 1, 0, None
                if slot[a] & 1:
                    summary = summary or Summary(SLACK * mass // least + 1)
                    summary.add(key[a:b].view(U64), n[a:b])
                else:
                    mass += int(n[a:b].sum())
        yield done()

    dealt = summaries.repartition(partitions, F.shiftright("slot", 1)).sortWithinPartitions("slot")
    return dealt.mapInArrow(run, "key long")


def phrase_counts(texts: DataFrame, known: dict[int, Broadcast]) -> DataFrame:
    """lang, phrase, n of the phrases that pass the filter of their number of words. Each slice's counts are rows, which
    Spark adds up before and after its shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _read(batches):
            for k, keys in words.phrases(max(known)):
                if k in known and len(at := np.flatnonzero(passes(known[k].value, keys) & words.in_piece(k))):
                    yield words.counted(at, k)

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, phrase, n of all single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _read(batches):
            if len(words):
                yield words.counted(np.arange(len(words)), 1)

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _word_keys(counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                key = mix(hashed(batch.column("phrase").to_pylist()) * ODD + hashed(batch.column("lang").to_pylist()))
                yield pa.record_batch({"key": key.view(np.int64)})

    return counts.select("lang", "phrase").mapInArrow(run, "key long")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n of all words; lang, phrase, n of all phrases of 2 to ``longest`` words with ``least`` occurrences or more).

    The texts are read four times: words, summaries of pairs, summaries of longer phrases, exact counts.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text"))
    words = saved(word_counts(texts))
    often = words.where(F.col("n") >= least)
    n, mass = often.agg(F.count("*"), F.sum("n")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(PARTS_EACH * partitions, -(-SLACK * (longest - 1) * (mass or 0) // (least * COUNTERS)))
    partitions = max(partitions, parts // PARTS_EACH)
    known = send(key_filter(_word_keys(often), n))
    filters = {}
    for lengths, unit in ((range(2, 3), 1), (range(3, longest + 1), 2)):
        if len(lengths):
            found = saved(survivors(summarised(texts, lengths, unit, known, parts), least, partitions))
            known = send(key_filter(found, found.count()))
            discard(found)
            filters |= dict.fromkeys(lengths, known)
    return words, saved(phrase_counts(texts, filters).where(F.col("n") >= least))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT) -> DataFrame:
    """One row a phrase, the first ``top`` of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` are the phrase's occurrences, ``l`` and ``r`` those of its two parts at the cut with the least score
    floor(1000 a n / (l r)), the first of equal ones; ``n`` are the words of the language. Products are decimals of up to 38
    digits. A candidate goes if its words lie within a longer one that has ``percent`` percent of its occurrences.

    A null text has no words, a null language is ``und``, repeated rows count again, and an empty table gives no
    rows; other columns are not looked at. A text of any length is held by one task whole, and its phrases are
    counted in slices of texts. A phrase in every text is one counter a task.
    """
    words, phrases = frequent_phrases(docs, text, lang, least, longest)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("total"))
    parts = words.where(F.col("n") >= least).union(phrases)
    said = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cut = said.select("*", F.posexplode(F.sequence(F.lit(1), F.size("w") - 1)).alias("_", "k"))
    joint = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cut = cut.select("lang", "phrase", "a", "k", joint(F.lit(1), F.col("k")).alias("first"), joint(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    for name, of in (("first", "l"), ("rest", "r")):
        cut = cut.join(parts.select("lang", F.col("phrase").alias(name), F.col("n").alias(of)), ["lang", name]).drop(name)
    whole = cut.join(sizes, "lang")
    score = F.expr("(1000BD * cast(a as decimal(16, 0)) * cast(total as decimal(16, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    least_cut = whole.withColumn("score", score).groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    inside = said.where(F.size("w") > 2).select("lang", "a", F.explode(F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = least_cut.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = kept.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", F.col("total").alias("n"), "c.score")
