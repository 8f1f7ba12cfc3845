"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only documents are labelled, so the tags of their words are latent: a document labelled clean has no toxic word, one
labelled toxic has some. The field is learned by the likelihood of just that: expected features given that some tag is
toxic, less expected features without it, both by forward-backward. Marginals give each word its probability; their
greatest and their sum, through a logistic fit to the documents' labels, give the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SLICE_BYTES, WORD, ragged, slices, strings, words

#: Labelled documents that are learned from at most, of each label: those whose ids hash lowest, with so many characters
#: of each.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 20_000
#: A feature is learned if so many documents have it; it begins with a weight by how much more frequent it is in toxic ones.
SUPPORT = 4
FEATURES = 1 << 18
EPOCHS, BATCH, RATE, KEEP = 6, 64, 0.2, 0.01
#: Words that a chain is cut into when all its parts go in step.
PART = 128
#: Words whose potentials a worker keeps.
KEPT_WORDS = 300_000
PREDICT, SPAN, DOUBT = 0.7, 0.5, 0.05
WORDS = re.compile(WORD)
STRIP = ".,;:!?\"'()[]{}<>|#*$%&+-=_/\\"


def form(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings of 3 to 7 letters."""
    plain = word.lower().strip(STRIP)
    return [f"w:{plain}", *(f"p:{plain[:k]}" for k in range(3, 8) if len(plain) > k)] if plain else ["w:"]


def hashed(features: list[str]) -> list[int]:
    return [xxhash.xxh32_intdigest(f) % FEATURES for f in features]


def chain(steps: np.ndarray) -> np.ndarray:
    """Share of state 1 after each of the 2 x 2 matrices (2, 2, n), which a row vector that begins even goes through.

    The matrices are cut into parts; all parts multiply in step, and each part's first vector comes from the totals of
    those before it."""
    n = steps.shape[2]
    parts = -(-n // PART)
    if not parts:
        return np.zeros(0)
    whole = np.ones((2, 2, parts * PART))
    whole[:, :, :n] = steps
    whole = whole.reshape(2, 2, parts, PART)
    product = np.empty_like(whole)
    now = whole[:, :, :, 0]
    for k in range(PART):
        if k:
            m = whole[:, :, :, k]
            now = now[:, :1] * m[0][None] + now[:, 1:] * m[1][None]
        now = now / now.sum(axis=(0, 1))
        product[:, :, :, k] = now
    first, v = np.empty(parts), 0.5
    for k, ((a, b), (c, d)) in enumerate(product[:, :, :, -1].transpose(2, 0, 1).tolist()):
        first[k] = v
        zero, one = (1 - v) * a + v * c, (1 - v) * b + v * d
        v = one / (zero + one)
    zero, one = ((1 - first)[:, None] * product[0, k] + first[:, None] * product[1, k] for k in (0, 1))
    return (one / (zero + one)).ravel()[:n]


@dataclass
class Field:
    """weights of features for the state toxic, transitions (from, to), and the logistic fit."""

    weights: np.ndarray
    trans: np.ndarray
    fit: np.ndarray

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        """The log potential of toxic for each word; that of clean is 0."""
        rows = [hashed(form(w)) for w in vocabulary]
        sizes = np.array([len(r) for r in rows], np.int64)
        if not len(rows):
            return np.zeros(0)
        flat = np.concatenate([np.array(r, np.int64) for r in rows])
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes)

    def messages(self, emission: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(share of toxic of the forward and of the backward message of each word, steps (from, to, word)). All texts are one
        chain: the step into a text's first word forgets what was before."""
        toxic = np.exp(np.clip(emission, -30, 30))
        steps = np.exp(self.trans)[:, :, None] * np.stack([np.ones(len(toxic)), toxic])[None]
        begin = starts[:-1][np.diff(starts) > 0]
        steps[:, 0, begin], steps[:, 1, begin] = 1.0, toxic[begin]
        ahead, back = chain(steps), np.full(len(toxic), 0.5)
        back[:-1] = chain(steps.transpose(1, 0, 2)[:, :, :0:-1])[::-1]
        return ahead, back, steps

    def marginals(self, emission: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probability of toxic of each word by forward-backward over its text."""
        ahead, back, _ = self.messages(emission, starts)
        both = ahead * back
        return both / np.maximum(both + (1 - ahead) * (1 - back), 1e-300)

    def expected(self, emission: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of toxic of each word, of each pair of tags (from, to) into each word but a text's first, and of no
        toxic word in each text)."""
        ahead, back, steps = self.messages(emission, starts)
        both = ahead * back
        marginal = both / np.maximum(both + (1 - ahead) * (1 - back), 1e-300)
        to = np.stack([1 - back, back])
        before = np.stack([1 - ahead, ahead])
        pair = before[:, None, :-1] * steps[:, :, 1:] * to[None, :, 1:]
        pair = np.concatenate([np.zeros((2, 2, 1)), pair / pair.sum(axis=(0, 1))], axis=2) if len(emission) else np.zeros((2, 2, 0))
        begin = starts[:-1][np.diff(starts) > 0]
        pair[:, :, begin] = 0
        # clean given that the word before is clean, from the first on
        clean = steps[0, 0] * to[0]
        log = np.log(np.maximum(clean / (clean + steps[0, 1] * to[1]), 1e-300))
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        return marginal, pair, np.exp(np.bincount(owner, weights=log, minlength=len(starts) - 1))

    def summary(self, marginal: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One, the greatest marginal, and the logarithms of their sum and of the number of those over ``DOUBT``, of each text."""
        n = len(starts) - 1
        owner = np.repeat(np.arange(n), np.diff(starts))
        top = np.zeros(n)
        np.maximum.at(top, owner, marginal)
        total, doubtful = (np.log1p(np.bincount(owner, weights=x, minlength=n)) for x in (marginal, marginal >= DOUBT))
        return np.stack([np.ones(n), top, total, doubtful], axis=1)

    def score(self, marginal: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.summary(marginal, starts) @ self.fit, -40, 40)))


def learn(sample: list[tuple[str, int]]) -> Field:
    """A field from (text, label) documents in a fixed order."""
    label = np.array([x[1] for x in sample], np.int64)
    vocabulary, codes, starts = words(pa.array([x[0] for x in sample], pa.string()))
    forms = [hashed(form(w)) for w in strings(vocabulary)]
    sizes, flat = np.array([len(f) for f in forms], np.int64), np.array([h for f in forms for h in f], np.int64)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(label)), np.diff(starts))
    field = Field(np.full(FEATURES, -0.5), np.zeros((2, 2)), np.zeros(4))
    # documents of each label that have each feature
    word, doc = np.unique(np.stack([codes, owner]), axis=1) if len(codes) else np.zeros((2, 0), np.int64)
    has = np.unique(np.stack([flat[ragged(begin[word], sizes[word])], np.repeat(doc, sizes[word])]), axis=1) if len(word) else np.zeros((2, 0), np.int64)
    count = [np.bincount(has[0][label[has[1]] == k], minlength=FEATURES) for k in (0, 1)]
    rate = [(count[k] + 0.5) / (1 + (label == k).sum()) for k in (0, 1)]
    told = count[0] + count[1] >= SUPPORT
    field.weights[told] += 0.5 * np.clip(np.log(rate[1][told] / rate[0][told]), -3, 3)
    prior = field.weights.copy()

    def potentials() -> np.ndarray:
        return np.add.reduceat(field.weights[flat], begin) if len(sizes) else np.zeros(0)

    scale, random = np.full(FEATURES, 1e-8), np.random.default_rng(3)
    full = np.flatnonzero(np.diff(starts))
    for _ in range(EPOCHS if 0 < label.sum() < len(label) else 0):
        order = random.permutation(full)
        for k in range(0, len(order), BATCH):
            docs = order[k : k + BATCH]
            at = np.concatenate([[0], np.cumsum(np.diff(starts)[docs])])
            own = codes[ragged(starts[docs], np.diff(starts)[docs])]
            marginal, pair, none = field.expected(potentials()[own], at)
            # given the label: nothing toxic, or all but the case of nothing toxic
            toxic = np.repeat(label[docs], np.diff(at)) == 1
            share = np.repeat(1 / np.maximum(1 - none, 1e-6), np.diff(at))
            wanted = np.where(toxic, np.minimum(marginal * share, 1), 0)
            step = np.bincount(flat, weights=np.repeat(np.bincount(own, weights=wanted - marginal, minlength=len(sizes)), sizes), minlength=FEATURES)
            hit = np.flatnonzero((np.abs(step) > 1e-4) & told)
            step = step[hit] - KEEP * (field.weights[hit] - prior[hit])
            scale[hit] += step**2
            field.weights[hit] += RATE * step / np.sqrt(scale[hit])
            inner = np.ones(len(own), bool)
            inner[at[:-1]] = False
            given = pair * np.where(toxic, share, 0)
            given[0, 0] = np.where(toxic, (pair[0, 0] - np.repeat(none, np.diff(at))) * share, 1.0) * inner
            field.trans += RATE * (given - pair)[:, :, inner].sum(axis=2) / max(1, int(toxic.sum()))
            np.clip(field.trans, -4, 4, out=field.trans)
    marginal = field.marginals(potentials()[codes], starts)
    x, y = field.summary(marginal, starts), label.astype(float)
    if 0 < y.sum() < len(y):
        for _ in range(3000):
            p = 1 / (1 + np.exp(-np.clip(x @ field.fit, -40, 40)))
            field.fit -= 0.5 * ((p - y) @ x / len(y) + 1e-4 * field.fit)
    else:
        field.fit[0] = -4.0
    return field


def id_hash(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> list[tuple[str, int]]:
    """(text, label) of up to ``SAMPLE_DOCS`` documents of each label among those whose id's remainder isn't 1."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (id_hash("doc_id") != 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.withColumn("h", F.md5(F.col("doc_id").cast("string")))
    chosen = usable.where("toxic = 0").orderBy("h").limit(SAMPLE_DOCS).union(usable.where("toxic = 1").orderBy("h").limit(SAMPLE_DOCS))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # of several rows of an id one, cut and not dropped if it is long
    one = texts.groupBy("h", "doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))).alias("row"))
    return [(r["text"], int(r["toxic"])) for r in one.select("h", "doc_id", "toxic", "row.text").orderBy("h", "doc_id").collect()]


def _score(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    known: dict[str, float] = {}
    for piece in slices(batches, most=2 * SLICE_BYTES):
        texts = piece.column("text")
        vocabulary, codes, starts = words(texts)
        names = strings(vocabulary)
        new = [w for w in names if w not in known]
        fresh = dict(zip(new, field.emissions(new).tolist()))
        potential = np.array([known[w] if w in known else fresh[w] for w in names])
        if len(known) < KEPT_WORDS:
            known.update(fresh)
        marginal = field.marginals(potential[codes], starts)
        score = field.score(marginal, starts)
        hits = np.flatnonzero(marginal >= SPAN)
        owner = np.searchsorted(starts, hits, side="right") - 1
        spans: list[list[str]] = [[] for _ in range(len(piece))]
        for i in np.unique(owner).tolist():
            wanted = set((hits[owner == i] - starts[i]).tolist())
            found = (m for k, m in enumerate(WORDS.finditer(texts[i].as_py())) if k in wanted)
            spans[i] = [f"{m.start()}:{m.end()}" for m in found]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score), pa.array((score >= PREDICT).astype(np.int32)), pa.array([",".join(s) for s in spans])], ["doc_id", "held_out", "score", "predicted", "spans"])


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start:end in code points of toxic words) of each row.

    Null and empty texts have no words and the score of a text without toxic words. Labels other than 0 and 1 are
    not learned from, an id with both counts as toxic; without both labels all scores are low. A null id is not held
    out. Repeated rows score alike; an empty table gives no rows; other columns are not looked at.
    """
    field = docs.sparkSession.sparkContext.broadcast(learn(labelled_sample(docs, labels, text, doc_id)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(id_hash(doc_id) == 1, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _score(it, field.value), f"doc_id {kind}, held_out boolean, score double, predicted int, spans string")
