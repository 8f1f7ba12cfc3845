"""Language identification by cross-parsing.

A suffix automaton of each language's labelled text recognises exactly the text's substrings. A document is parsed
against it into the fewest greedy phrases: the longest match from here, then the longest match from there. The
cost of a language is what its phrases need to be named, over the symbols parsed; the least cost wins.
Texts are lower-cased, and what stands between words is one symbol; phrases go on over it. Texts are parsed whole. So that
texts of all lengths go in step they are first parsed in parts, and the parts are then parsed again from where the part before
ended, until they are where they were: two parses that meet go on together.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import slices, strings

#: Documents of each language that are learned from, those whose ids hash lowest, with so many characters of each document; and
#: symbols of a language's text. All languages are learned.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LETTERS = 64, 8_000, 24_000
#: Symbols of all languages' texts together, about: where languages are many, each has less text, but this much at least.
ALL_LETTERS, LEAST_LETTERS = 600_000, 1_500
#: Symbols of a part.
PART = 256
#: Every so many documents of a language's sample are left out of its text and tell what its texts cost.
LEFT_OUT = 4
#: A document is rejected if it has no letter, or costs this many times what nearly all documents of its language do. Texts
#: of fewer symbols tell no cost, and this many phrases of a text are not counted for it, as the first are short ones.
REJECT, QUANTILE, LEAST_SYMBOLS, FREE_PHRASES = 1.25, 0.98, 50, 4
#: Bytes of text that are parsed at a time.
SLICE = 1 << 20
#: Symbols: between words, and a letter that the sample doesn't have.
GAP, UNSEEN = 0, 1


@cache
def letters() -> np.ndarray:
    """For each code point 2 if it is a letter, 1 if it is a mark that goes with letters, 0 for all else."""
    return np.frombuffer(bytes({"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8)


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of letters and marks, -1 for what stands between; where each text's start, one more than texts;
    whether each text has a letter)."""
    texts = [t.lower() for t in texts]
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int32)
    ends = np.cumsum([0, *map(len, texts)])
    kind = letters()[flat]
    part = kind > 0
    after = np.zeros(len(flat), bool)
    after[1:] = part[:-1]
    after[ends[:-1][ends[:-1] < len(flat)]] = False
    kept = part | after
    count = np.concatenate([[0], np.cumsum(kept)])
    real = np.concatenate([[0], np.cumsum(kind == 2)])
    return np.where(part, flat, -1)[kept], count[ends], np.diff(real[ends]) > 0


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The moves of each state of the automaton that accepts the substrings of the symbols."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for s in symbols:
        state = len(moves)
        lengths.append(lengths[last] + 1)
        moves.append({})
        links.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = state
            p = links[p]
        if p >= 0:
            q = moves[p][s]
            if lengths[q] == lengths[p] + 1:
                links[state] = q
            else:
                clone = len(moves)
                lengths.append(lengths[p] + 1)
                moves.append(dict(moves[q]))
                links.append(links[q])
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = clone
                    p = links[p]
                links[q] = links[state] = clone
        last = state
    return moves


@dataclass
class Automaton:
    """Moves of all states in one row of cells: that of a state by a symbol is at base[state] + symbol, if owner there is the
    state. Rows of cells lie in each other's gaps, so the size goes with the moves and not with the alphabet."""

    base: np.ndarray
    owner: np.ndarray
    to: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, moves: list[dict[int, int]], width: int) -> Automaton:
        total = sum(map(len, moves))
        used = bytearray(4 * total + 4 * width)
        base = np.zeros(len(moves), np.int32)
        owner, to = np.full(len(used), -1, np.int32), np.zeros(len(used), np.int32)
        low = [0, 0]  # where rows of one cell, and of several, look for room from
        for state in sorted(range(len(moves)), key=lambda k: (-len(moves[k]), k)):
            keys = sorted(moves[state])
            if not keys:
                continue
            several, tried = len(keys) > 1, 0
            at = max(low[several], keys[0])
            while True:
                at = used.find(0, at)
                if at < 0 or at + keys[-1] - keys[0] >= len(used):
                    at = len(used) if at < 0 else at
                    more = at + width + 1 - len(used) + total
                    used += bytes(more)
                    owner, to = np.concatenate([owner, np.full(more, -1, np.int32)]), np.concatenate([to, np.zeros(more, np.int32)])
                if not any(used[at - keys[0] + k] for k in keys):
                    break
                at, tried = at + 1, tried + 1
            if not several or tried > 64:
                low[several] = at
            base[state] = at - keys[0]
            for k in keys:
                used[base[state] + k], owner[base[state] + k], to[base[state] + k] = 1, state, moves[state][k]
        first = np.zeros(width, np.int32)
        first[list(moves[0])] = list(moves[0].values())
        # a look-up past the last cell must find no owner
        size = max(len(used.rstrip(b"\0")), int(base.max())) + width
        owner, to = (np.concatenate([x[:size], np.full(max(0, size - len(x)), -1, np.int32)]) for x in (owner, to))
        return cls(base, owner, to, first)


@dataclass
class Model:
    langs: list[str]
    #: The symbol of each code point of the sample's letters.
    symbol: dict[int, int]
    tables: list[Automaton]
    #: What a phrase costs: log2 of its place in the language's text, and of the symbol that ends it.
    bits: np.ndarray
    #: Cost a symbol of each language above which a document is rejected.
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def symbols(self, flat: np.ndarray) -> np.ndarray:
        table = np.full(0x110001, UNSEEN, np.int32)
        table[list(self.symbol)] = list(self.symbol.values())
        table[-1] = GAP
        return table[flat]

    def phrases(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Number of phrases (text, language) of texts of code points."""
        n = len(starts) - 1
        out = np.zeros((n, len(self.langs)), np.int64)
        parts = -(-np.diff(starts) // PART)
        owner = np.repeat(np.arange(n), parts)
        number = np.arange(len(owner)) - (np.cumsum(parts) - parts)[owner]
        begin = starts[:-1][owner] + PART * number
        size = np.minimum(starts[1:][owner] - begin, PART)
        order = np.argsort(-size, kind="stable")
        place = np.argsort(order)  # of each part in the order of sizes
        before = np.where(number > 0, place[np.arange(len(owner)) - 1], -1)[order] if len(owner) else number
        owner, begin, size = owner[order], begin[order], size[order]
        steps = int(size[0]) if len(size) else 0
        alive = np.searchsorted(-size, -np.arange(steps), side="left")  # parts longer than t
        symbols = self.symbols(flat)
        grid = [symbols[begin[: alive[t]] + t] for t in range(steps)]
        for lang, table in enumerate(self.tables):
            out[:, lang] = np.bincount(owner, weights=self._whole(table, grid, size, before), minlength=n)
        return out

    @staticmethod
    def _whole(table: Automaton, grid: list[np.ndarray], size: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Phrases that begin in each part. grid: the parts' symbols, step by step, of the parts longer than the step; before: the
        part that a part follows, -1 for none."""

        def step(state: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            cell = table.base[state] + s
            new = (table.owner[cell] != state) | (state == 0)
            # an unseen symbol is a phrase by itself
            return np.where(new, table.first[s], table.to[cell]), new

        state, states, begun = np.zeros(len(size), np.int32), [], []
        for s in grid:
            state[: len(s)], new = step(state[: len(s)], s)
            states.append(state[: len(s)].copy())
            begun.append(new)
        # from here on, state is where each part ended
        came, follows = np.zeros(len(size), np.int32), np.flatnonzero(before >= 0)
        while len(live := follows[state[before[follows]] != came[follows]]):
            came[live] = now = state[before[live]]
            for t, s in enumerate(grid):
                own = size[live] > t
                live, now = live[own], now[own]
                if not len(live):
                    break
                now, new = step(now, s[live])
                met = states[t][live] == now
                states[t][live], begun[t][live] = now, new
                ended = size[live] == t + 1
                state[live[ended]] = now[ended]
                live, now = live[~met], now[~met]
        count = np.zeros(len(size), np.int64)
        for new in begun:
            count[: len(new)] += new
        return count

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cost a symbol by text and language, the same without the first phrases, symbols, whether there is a letter)."""
        flat, starts, lettered = points(texts)
        count, size = self.phrases(flat, starts), np.maximum(np.diff(starts), 1)[:, None]
        return count * self.bits / size, np.maximum(count - FREE_PHRASES, 0) * self.bits / size, np.diff(starts), lettered


def learn(sample: list[tuple[str, str]]) -> Model:
    """A model of (lang, text) documents, given in a fixed order."""
    by_lang: dict[str, list[str]] = {}
    for lang, text in sample:
        if points([text])[2][0]:
            by_lang.setdefault(lang, []).append(text)
    langs = sorted(by_lang)
    letters_each = min(SAMPLE_LETTERS, max(LEAST_LETTERS, ALL_LETTERS // max(1, len(langs))))
    learned, left = {}, {}
    for lang, texts in by_lang.items():
        left[lang] = texts[LEFT_OUT - 1 :: LEFT_OUT]
        flat = [points([t])[0] for k, t in enumerate(texts) if k % LEFT_OUT != LEFT_OUT - 1]
        learned[lang] = np.concatenate([x for t in flat for x in (t, np.array([-1], np.int32))])[:letters_each]
    seen = np.unique(np.concatenate(list(learned.values()))) if langs else np.zeros(0, np.int32)
    symbol = {int(c): k + UNSEEN + 1 for k, c in enumerate(seen[seen >= 0])}
    width = len(symbol) + UNSEEN + 1
    model = Model(langs, symbol, [], np.log2([float(len(learned[x]) * width) for x in langs]))
    for lang in langs:
        model.tables.append(Automaton.of(suffix_automaton(model.symbols(learned[lang]).tolist()), width))
    limits = []
    for k, lang in enumerate(langs):
        _, cost, size, _ = model.costs(left[lang])
        told = cost[size >= LEAST_SYMBOLS, k]
        limits.append(REJECT * float(np.quantile(told, QUANTILE)) if len(told) else np.inf)
    model.most = np.array(limits)
    return model


def id_hash(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, by its remainder."""
    return F.crc32(F.col(doc_id).cast("string")) % of


def labelled_sample(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> list[tuple[str, str]]:
    """(lang, text) of up to ``SAMPLE_DOCS`` documents of each language among those whose id's remainder isn't 2, one row an
    id. The ids are chosen by their hash on all rows; only the chosen texts reach the driver, cut to ``SAMPLE_CHARS``."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_hash("id", 4) != 2))
    one = usable.groupBy("lang", "id").agg(F.min("t").alias("t"))
    order = Window.partitionBy("lang").orderBy(F.md5(F.col("id").cast("string")), "id")
    chosen = one.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
    # a few rows a language; Spark's size check decides whether they are broadcast
    cut = usable.join(chosen, ["lang", "id", "t"]).select("lang", "id", "n", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    found = cut.dropDuplicates(["lang", "id"]).orderBy("lang", "n").collect()
    return [(r["lang"], r["text"]) for r in found]


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, most=SLICE):
        texts, n = strings(piece.column("text")), len(piece)
        if model.langs:
            cost, later, _, known = model.costs(texts)
        else:
            cost = later = np.zeros((n, 1))
            known = np.zeros(n, bool)
        best = cost.argmin(axis=1)
        least = cost[np.arange(n), best]
        second = np.partition(cost, 1, axis=1)[:, 1] if cost.shape[1] > 1 else np.maximum(least, 1)
        score = np.where(known, np.clip(second / np.maximum(least + second, 1e-12), 0, 1), 0.0)
        lang = [model.langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
        accepted = known & (later[np.arange(n), best] <= (model.most[best] if model.langs else 0))
        yield pa.RecordBatch.from_arrays([*(piece.column(k) for k in range(piece.num_columns - 1)), pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)], [*piece.schema.names[:-1], "lang_pred", "score", "accepted"])


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of each row.

    Learned from rows with a language and a text whose id's remainder isn't 2 (a null id is not learned from). A null
    text, or one without a letter, is ``und`` with score 0 and not accepted; without any labelled row all are. The
    score is the second least cost over the sum of the two least: 0.5 is a tie, and a tie goes to the first language
    in order. Other columns are not looked at; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(labelled_sample(docs, text, lang, doc_id)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(id_hash(doc_id, 4) == 2, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _score(it, model.value), f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def accepted_documents(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose text is in one of the learned languages, unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(learn(labelled_sample(docs, text, lang, doc_id)))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                waiting.append(batch)
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(text))], ["text"])

        done = 0
        for scored in _score(texts(), model.value):  # pieces of a batch, in order
            yield waiting[0].slice(done, len(scored)).filter(scored.column(2))
            done += len(scored)
            if done == len(waiting[0]):
                waiting.pop(0)
                done = 0

    return docs.mapInArrow(keep, docs.schema)
