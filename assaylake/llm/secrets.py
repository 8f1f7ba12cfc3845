"""Secret scan: fixed patterns, and a character convolutional network over every candidate and its context.

The patterns' findings in all rows are the positive labels, all other candidates of all rows the negative ones, each
distinct one once. A finding's own context holds the pattern's keyword, so it is masked: values and words are learned between
characters that stand around other words, values also cut, upper-cased and in other letters, so that the value alone must tell.
Training is by rounds: what is learned is dealt into parts by hash, each part goes on from the same network in a task of its own,
and the parts' networks are averaged. The network is calibrated, and its threshold set, on all that a hash holds back: ``RECALL``
of the values there must pass.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .text import runs, slices

#: Kinds of findings in the order that breaks ties; the last is the network's.
KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
#: RE2 form of the start of ASSIGN, to find the few texts that the pattern is run on.
ASSIGN_START = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
#: A candidate: this many characters of a value or more, as the shortest value that is learned.
CANDIDATE_LEAST = ASSIGN_LEAST
WORDS = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_LEAST)
DIGIT = re.compile("[0-9]")
VALUE, HEX = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", b"0123456789abcdef"))

#: Examples of a kind that ``labelled_examples`` takes of texts at hand; ``learn`` takes all of all rows.
EXAMPLES = 1500
#: Examples of a kind in a part, about; values that each part has at least, if there are so many; characters of text to a context; words
#: that a task holds before it hands them on.
PART_ROWS, PART_VALUES, CONTEXT_EACH, HELD_WORDS = 1 << 16, 64, 4096, 200_000
#: Rounds over many parts at least, examples of a step there, and words to one example of a value.
LEAST_ROUNDS, PART_BATCH, VALUE_EACH = 4, 128, 8
#: Outputs are counted in so many bins from -EDGE to EDGE.
EDGE, BINS = 40, 1 << 14
#: Characters read of a candidate at a time and on each side of it.
BODY, SIDE = 64, 16
CLASSES, CHANNELS, FILTERS, REACH = 128, 8, 24, 5
#: What changed values are made of, and the shortest part that a value is cut to.
ALPHABET, VARIANT_LEAST = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 16
#: Characters that candidates are scored in at a time, so few that their filters stay in a core's cache, and places whose maximum is
#: taken for all candidates at once: at most those of a window.
SCORED, SPAN = 1 << 14, 32
RECALL, EPOCHS, BATCH, RATE, SEED = 0.99, 12, 64, 0.01, 7
NAMES = ("embed", "filters", "bias", "out", "out_bias")


def base_spans(text: str, hexes: list[tuple[int, int]] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' findings."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if hexes is None:
        hexes = [m.span() for m in re.finditer(r"[0-9a-f]{%d,}" % HEX_LEAST, text)]
    return out + [(a, b, "hex") for a, b in hexes]


def byte_runs(texts: pa.Array, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text's index, start, end in its code points) of the runs of ASCII bytes in the table, ``least`` long."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    if not len(texts) or not ends[-1]:
        return (np.zeros(0, np.int64),) * 3
    data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts.cast(pa.string())), "")[0].as_buffer(), np.uint8)
    # a run may go on over the end of a text: a gap of one cell after each text parts it there
    place = np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)
    inside = np.zeros(len(data) + len(sizes), bool)
    inside[place] = table[data]
    a, b = runs(inside)
    a, b = a[b - a >= least], b[b - a >= least]
    owner = np.searchsorted(ends + np.arange(len(sizes)), a, side="right")
    # code points before each byte of all texts, and before each text
    points = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
    first = points[np.concatenate([[0], ends])[owner]]
    start = points[a - owner] - first
    return owner, start, start + b - a


def window(text: str, start: int, end: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The windows that show a candidate: SIDE characters, up to BODY of the value, SIDE characters; a longer value
    has several windows, which overlap by half."""
    out = []
    for at in range(start, max(start + 1, end - BODY // 2), BODY // 2):
        stop = min(end, at + BODY)
        row = np.zeros(BODY + 2 * SIDE, np.int64)
        before, body, after = text[max(0, at - SIDE) : at], text[at:stop], text[stop : stop + SIDE]
        for place, part in ((SIDE - len(before), before), (SIDE, body), (SIDE + len(body), after)):
            row[place : place + len(part)] = [min(ord(c), CLASSES - 1) for c in part]
        out.append(row)
        if stop == end:
            break
    return out


@dataclass
class Network:
    """Embedding, convolution, maximum over places, one output; ``scale`` and ``shift`` calibrate it."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        # beyond the last character all is alike, so one place of that is enough
        used = np.flatnonzero(x.any(axis=0))
        n = min(x.shape[1], used[-1] + 1 + REACH if len(used) else x.shape[1]) - REACH + 1
        table = self.table()
        h = table[0].take(x[:, :n], axis=0)
        for k in range(1, REACH):
            h += table[k].take(x[:, k : k + n], axis=0)
        top = h.argmax(axis=1)
        peak = np.maximum(np.take_along_axis(h, top[:, None], 1)[:, 0], 0)
        return peak @ self.out + self.out_bias[0], peak, top

    def table(self) -> np.ndarray:
        """What a character adds to each filter, by its place there; the last place has the bias."""
        out = np.einsum("kc,crf->rkf", self.embed, self.filters.reshape(CHANNELS, REACH, FILTERS))
        out[-1] += self.bias
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the first two characters of a place, the next two and the fifth add to each filter, in single precision."""
        table = self.table()
        first, second = ((table[k][:, None] + table[k + 1]).reshape(-1, FILTERS) for k in (0, 2))
        return first.astype(np.float32), second.astype(np.float32), table[4].astype(np.float32)

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.forward(x[k : k + 256])[0] for k in range(0, len(x), 256)]) if len(x) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -40, 40)))

    def found(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether each candidate of ``codes`` (of all texts, with 2 * SIDE zeros around each) passes the threshold.

        The same as for its windows one by one, but each character is read once for all windows that show it."""
        parts = np.maximum(1, -(-(end - start - BODY // 2) // (BODY // 2)))
        owner = np.repeat(np.arange(len(start)), parts)
        at = start[owner] + BODY // 2 * (np.arange(len(owner)) - (np.cumsum(parts) - parts)[owner])
        stop = np.minimum(end[owner], at + BODY)
        first, second, fifth = self.pairs()
        good = np.zeros(len(start), bool)
        cuts = np.flatnonzero(np.diff(at // SCORED, prepend=-1)) if len(at) else []
        for a, b in zip(cuts, [*cuts[1:], len(at)]):
            size = stop[a:b] - at[a:b]
            base = at[a] - SIDE
            region = codes[base : stop[a:b].max() + SIDE + REACH].astype(np.intp)
            low, ends = at[a:b] - SIDE - base, stop[a:b] + SIDE - REACH + 1 - base
            pair, n = region[:-1] * CLASSES + region[1:], len(region) - REACH + 1
            h = first.take(pair[:n], axis=0)
            h += second.take(pair[2 : n + 2], axis=0)
            h += fifth.take(region[4 : n + 4], axis=0)
            # the maximum of each SPAN places in a row, by doubling; a window has more than one and less than three of those
            for k in range(SPAN.bit_length() - 1):
                h = np.maximum(h[: -(1 << k)], h[1 << k :])
            peak = np.maximum(h.take(low, axis=0), h.take(ends - SPAN, axis=0))
            wide = np.flatnonzero(ends - low > 2 * SPAN)
            peak[wide] = np.maximum(peak[wide], h.take(low[wide] + SPAN, axis=0))
            # after a window's text there are zeros up to its full width
            tail = np.zeros((2 * REACH - 1, b - a), np.intp)
            tail[: REACH - 1] = region[ends + np.arange(REACH - 1)[:, None]]
            for k in range(REACH):
                last = first.take(tail[k] * CLASSES + tail[k + 1], axis=0)
                last += second.take(tail[k + 2] * CLASSES + tail[k + 3], axis=0)
                last += fifth.take(tail[k + 4], axis=0)
                last[size + k >= BODY] = -np.inf
                np.maximum(peak, last, out=peak)
            z = np.maximum(peak, 0) @ self.out + self.out_bias[0]
            passed = 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -40, 40))) >= self.threshold
            good[owner[a:b][passed]] = True
        return good


def untrained(random: np.random.Generator) -> Network:
    return Network(random.normal(0, 0.3, (CLASSES, CHANNELS)), random.normal(0, 0.15, (CHANNELS * REACH, FILTERS)), np.zeros(FILTERS), random.normal(0, 0.2, FILTERS), np.zeros(1))


class Moments:
    """What Adam keeps of earlier steps."""

    def __init__(self) -> None:
        self.first, self.second, self.steps = dict.fromkeys(NAMES, 0.0), dict.fromkeys(NAMES, 0.0), 0


def step(net: Network, x: np.ndarray, y: np.ndarray, order: np.ndarray, state: Moments, batch: int = BATCH, rate: float = RATE, positive: float = 1.0) -> None:
    """One pass over the windows x in this order, by Adam; a label 1 weighs ``positive``."""
    for k in range(0, len(order), batch):
        rows, want = x[order[k : k + batch]], y[order[k : k + batch]]
        z, peak, top = net.forward(rows)
        weight = np.where(want > 0, positive, 1.0)
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - want) * weight / weight.sum()
        dpeak = d[:, None] * net.out * (peak > 0)
        # the slope by place in the filter, character and filter tells those of filters and characters
        codes = rows[np.arange(len(rows))[:, None, None], top[:, :, None] + np.arange(REACH)].astype(np.int64)
        at = (np.arange(REACH) * CLASSES + codes) * FILTERS + np.arange(FILTERS)[None, :, None]
        slope = np.bincount(at.ravel(), np.repeat(dpeak.ravel(), REACH), REACH * CLASSES * FILTERS).reshape(REACH, CLASSES, FILTERS)
        filters = net.filters.reshape(CHANNELS, REACH, FILTERS)
        g = {"out": peak.T @ d, "out_bias": np.array([d.sum()]), "bias": dpeak.sum(axis=0), "filters": (net.embed.T @ slope).transpose(1, 0, 2).reshape(CHANNELS * REACH, FILTERS), "embed": (slope @ filters.transpose(1, 2, 0)).sum(axis=0)}
        state.steps += 1
        for name in NAMES:
            state.first[name] = 0.9 * state.first[name] + 0.1 * g[name]
            state.second[name] = 0.999 * state.second[name] + 0.001 * g[name] ** 2
            own = getattr(net, name)
            setattr(net, name, (own - rate * (state.first[name] / (1 - 0.9**state.steps)) / (np.sqrt(state.second[name] / (1 - 0.999**state.steps)) + 1e-8)).astype(own.dtype))


def calibrate(net: Network, z: np.ndarray, want: np.ndarray, weight: np.ndarray) -> None:
    """Scale and shift by a logistic fit of the outputs, held near the identity."""
    a, b, weight = 1.0, 0.0, weight / weight.sum()
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        a -= 0.05 * (((p - want) * z * weight).sum() + 0.01 * (a - 1))
        b -= 0.05 * (((p - want) * weight).sum() + 0.01 * b)
    net.scale, net.shift = float(a), float(b)


def train(x: np.ndarray, y: np.ndarray, owner: np.ndarray | None = None) -> Network | None:
    """The network for windows x and labels y, None if a label is missing. A quarter of the documents ``owner`` of each label
    is held back, for the threshold; by default each window is a document of its own."""
    if len(set(y.tolist())) < 2:
        return None
    random = np.random.default_rng(SEED)
    owner = np.arange(len(x)) if owner is None else owner
    back: set[int] = set()
    for label in (1, 0):  # one at least; a label's only document is also learned
        docs = random.permutation(np.unique(owner[(y > 0) == label]))
        back |= set(docs[: max(1, len(docs) // 4)].tolist())
    held = np.isin(owner, list(back))
    used = ~held
    for label in (False, True):
        if not (used & ((y > 0) == label)).any():
            used |= (y > 0) == label
    held, used = np.flatnonzero(held), random.permutation(np.flatnonzero(used))
    net = untrained(random)
    state = Moments()
    for _ in range(EPOCHS):
        random.shuffle(used)
        step(net, x, y, used, state)
    rows = x[held]
    z, want = np.concatenate([net.forward(rows[k : k + 256])[0] for k in range(0, len(rows), 256)]), y[held]
    calibrate(net, z, want, np.ones(len(z)))
    p = net.probability(rows)
    asked = want > 0
    # as high as recall allows, less what single precision may differ by
    net.threshold = float(np.sort(p[asked])[int((1 - RECALL) * asked.sum())]) * (1 - 1e-4)
    return net


def network_spans(texts: list[str], net: Network) -> Iterator[tuple[int, int, int]]:
    """(text's index, start, end) of every candidate that the network finds."""
    gap = "\0" * (2 * SIDE)
    codes = np.minimum(np.frombuffer((gap + "".join(t + gap for t in texts)).encode("utf-32-le"), np.uint32), CLASSES - 1).astype(np.uint8)
    starts = np.cumsum([len(gap), *(len(t) + len(gap) for t in texts)])
    a, b = runs(VALUE[codes])
    long_ = b - a >= CANDIDATE_LEAST
    a, b = a[long_], b[long_]
    good = net.found(codes, a, b)
    owner = np.searchsorted(starts, a[good], side="right") - 1
    yield from zip(owner.tolist(), (a[good] - starts[owner]).tolist(), (b[good] - starts[owner]).tolist())


def variants(value: str, random: np.random.Generator) -> list[str]:
    """A value as it is, cut to a part, in upper case, and with its characters drawn anew from letters and digits."""
    size = int(random.integers(min(len(value), VARIANT_LEAST), len(value) + 1))
    drawn = dict(zip(sorted(set(value)), random.choice(list(ALPHABET), len(set(value))).tolist()))
    mixed = "".join(random.choice(list(ALPHABET), len(value)).tolist()) if any(c.isdigit() for c in value) else "".join(drawn[c] for c in value)
    return [value, value[:size], value.upper(), mixed[:size]]


def labelled_examples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels, and the index of the text that each is from. A value that was there before is left out. Of the
    negative examples one half are long or of digits, the other words of any length from all texts, each also in capitals."""
    random = np.random.default_rng(SEED)
    values: list[tuple[int, str]] = []
    no: list[tuple[int, str, int, int]] = []
    plain: list[tuple[int, str, int, int]] = []
    known: set[str] = set()
    each = max(1, EXAMPLES // max(1, len(texts)))
    for i, text in enumerate(texts):
        spans = base_spans(text)
        free = np.ones(len(text) + 1, bool)
        for start, end, _ in spans:
            free[start:end] = False
            value = re.search(r"[A-Za-z0-9+/_.=-]+$", text[start:end])
            if value and value.group() not in known and len(values) < EXAMPLES:
                known.add(value.group())
                values.append((i, value.group()))
        long_ = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_.=-]{12,}|[0-9]{6,}", text) if free[m.start() : m.end()].all()]
        words = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_LEAST, text) if free[m.start() : m.end()].all()]
        for out, found in ((no, long_), (plain, words)):
            out += [(i, text, a, b) for a, b in found[:: max(1, len(found) // each)][:each] if len(out) < EXAMPLES]
    # words in capitals are as little secrets as words are
    shapes = [(i, text[max(0, a - SIDE) : a], shape, text[b : b + SIDE]) for i, text, a, b in [*no, *plain] for shape in dict.fromkeys((text[a:b], text[a:b].upper(), text[a:b].title()))]
    shapes += [(i, "", text[a:b], "") for i, text, a, b in [*no, *plain]]  # and all without what is around them
    rows = [(i, w, 0.0) for i, before, shape, after in shapes for w in window(before + shape + after, len(before), len(before) + len(shape))]
    around = [(text[max(0, a - SIDE) : a], text[b : b + SIDE]) for _, text, a, b in [*plain, *no]] or [("", "")]
    for i, value in values:
        for k, shape in enumerate([value, *variants(value, random)]):
            before, after = around[int(random.integers(len(around)))] if k else ("", "")
            rows += [(i, w, 1.0) for w in window(before + shape + after, len(before), len(before) + len(shape))]
    return np.array([w for _, w, _ in rows]).reshape(-1, BODY + 2 * SIDE), np.array([y for *_, y in rows]), np.array([i for i, *_ in rows], np.int64)


def _patterns(texts: pa.Array) -> list[list[tuple[int, int, str]]]:
    """The patterns' findings of each text."""
    hexes: dict[int, list[tuple[int, int]]] = {}
    # few texts have such a run: only theirs are looked up
    some = np.flatnonzero(pc.match_substring_regex(texts, "[0-9a-f]{%d}" % HEX_LEAST).to_numpy(zero_copy_only=False))
    for i, a, b in zip(*(x.tolist() for x in byte_runs(texts.take(pa.array(some)), HEX, HEX_LEAST))):
        hexes.setdefault(int(some[i]), []).append((a, b))
    maybe = pc.or_(pc.match_substring_regex(texts, ASSIGN_START), pc.match_substring(texts, "AKIA")).to_numpy(zero_copy_only=False)
    spans: list[list[tuple[int, int, str]]] = [[] for _ in range(len(texts))]
    for i in {*hexes, *np.flatnonzero(maybe).tolist()}:
        spans[i] = base_spans(texts[i].as_py() if maybe[i] else "", hexes.get(i, []))
    return spans


#: What ``_examples`` tells of texts.
WORD_KIND, VALUE_KIND, AROUND_KIND = range(3)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind, value, after: words outside of the patterns' findings, the findings' values, and as value and after what is
    around one word in each ``CONTEXT_EACH`` characters. Each is told once, or again where a task has very many."""
    words: set[str] = set()
    others: set[tuple[int, str, str]] = set()

    def told() -> pa.RecordBatch:
        kinds = [WORD_KIND] * len(words) + [k for k, _, _ in others]
        columns = [pa.array(kinds, pa.int32()), pa.array([*words, *(v for _, v, _ in others)], pa.string()), pa.array([""] * len(words) + [a for *_, a in others], pa.string())]
        words.clear(), others.clear()
        return pa.RecordBatch.from_arrays(columns, ["kind", "value", "after"])

    for piece in slices(batches):
        for text, spans in zip(piece.column("text").to_pylist(), _patterns(piece.column("text"))):
            free = bytearray(b"\1") * (len(text) + 1) if spans else b""
            for start, end, _ in spans:
                free[start:end] = bytes(end - start)
                value = re.search(r"[A-Za-z0-9+/_.=-]+$", text[start:end])
                if value:
                    others.add((VALUE_KIND, value.group(), ""))
            words.update((m.group() for m in WORDS.finditer(text) if 0 not in free[m.start() : m.end()]) if spans else WORDS.findall(text))
            for at in range(zlib.crc32(text[:CONTEXT_EACH].encode()) % min(CONTEXT_EACH, len(text) or 1), len(text), CONTEXT_EACH):
                m = WORDS.search(text, at) or WORDS.search(text)
                if m and 0 not in free[max(0, m.start() - SIDE) : m.end() + SIDE]:
                    others.add((AROUND_KIND, text[max(0, m.start() - SIDE) : m.start()], text[m.end() : m.end() + SIDE]))
            if len(words) + len(others) > HELD_WORDS:
                yield told()
    yield told()


def _windows(shapes: list[str], around: list[tuple[str, str]]) -> np.ndarray:
    """All windows of each value, between what is around it."""
    parts, long_ = [], []
    for shape, (before, after) in zip(shapes, around):
        if len(shape) <= BODY:
            parts.append((before.rjust(SIDE, "\0") + shape + after).ljust(BODY + 2 * SIDE, "\0"))
        else:
            long_ += window(before + shape + after, len(before), len(before) + len(shape))
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, BODY + 2 * SIDE)
    return np.concatenate([np.minimum(codes, CLASSES - 1).astype(np.uint8), np.array(long_, np.uint8).reshape(-1, BODY + 2 * SIDE)])


def part_examples(words: list[str], values: list[str], around: list[tuple[str, str]], turn: int, random: np.random.Generator, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels of a part's turn. A word is as it is, in capitals, as a title or without what is around it, by turns;
    a value is there with all its variants, drawn again with others around each until there are ``least`` of them. Words with a
    digit, the likest to values, are repeated likewise."""
    around = around or [("", "")]
    drawn = lambda n: [around[k] for k in random.integers(len(around), size=n).tolist()]
    digits = [w for w in words if DIGIT.search(w)]
    words = words + digits * max(0, least // len(digits) - 1) if digits else words
    no = [(w, w.upper(), w.title(), w)[(i + turn) % 4] for i, w in enumerate(words)]
    no_around = [("", "") if (i + turn) % 4 == 3 else a for i, a in enumerate(drawn(len(no)))]
    again = max(1, -(-least // (5 * len(values)))) if values else 0
    yes = [x for v in values * again for x in (v, v, *variants(v, random)[1:])]
    yes_around = [a if i % 5 else ("", "") for i, a in enumerate(drawn(len(yes)))]
    x0, x1 = _windows(no, no_around), _windows(yes, yes_around)
    return np.concatenate([x0, x1]), np.repeat([0.0, 1.0], [len(x0), len(x1)])


def _by_part(batches: Iterator[pa.RecordBatch], kinds: tuple[str, str]) -> Iterator[tuple[int, list[str], list[str], list[tuple[str, str]]]]:
    """part, words, values and contexts of each part of a task, in an order that the table's own doesn't tell."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    for part in sorted(pc.unique(table["part"]).to_pylist()):
        rows = table.filter(pc.equal(table["part"], part)).sort_by([("h", "ascending"), ("value", "ascending"), ("after", "ascending")])
        of = lambda kind, use: rows.filter(pc.and_(pc.equal(rows["kind"], kind), rows[use]) if use else pc.equal(rows["kind"], kind))
        near = of(AROUND_KIND, "")
        yield part, of(WORD_KIND, kinds[0])["value"].to_pylist(), of(VALUE_KIND, kinds[1])["value"].to_pylist(), list(zip(near["value"].to_pylist(), near["after"].to_pylist()))


def learn(docs: DataFrame, text: str = "text") -> Network | None:
    """A network from all rows: every distinct word and value of every whole text is an example. The table of examples stays
    on the executors; the driver has a network of each part, which it averages, and counts of outputs by bin."""
    rows = docs.select(F.col(text).alias("text")).where("text IS NOT NULL")
    # a value that is also a word somewhere is a value
    told = rows.mapInArrow(_examples, "kind int, value string, after string").groupBy("value", "after").agg(F.max("kind").alias("kind"))
    told = told.withColumn("h", F.xxhash64("kind", "value", "after")).withColumn("held", F.expr("pmod(h, 4) = 0")).persist(StorageLevel.DISK_ONLY)
    dealt = None
    try:
        n = {(r["kind"], r["held"]): r["count"] for r in told.groupBy("kind", "held").count().collect()}
        n_words, n_values = (n.get((k, True), 0) + n.get((k, False), 0) for k in (WORD_KIND, VALUE_KIND))
        if not n_words or not n_values:
            return None
        parts = max(1, *(x // PART_ROWS for x in (n_words, n_values, n.get((AROUND_KIND, True), 0) + n.get((AROUND_KIND, False), 0))))
        # few values are learned in several parts each, so that no part lacks them
        copies = min(parts, -(-parts * PART_VALUES // n_values))
        spread = F.when((F.col("kind") == VALUE_KIND) & ~F.col("held"), copies).otherwise(1)
        # a label that is wholly held back, or not at all, is both learned and held back
        both = [k for k in (WORD_KIND, VALUE_KIND) if not n.get((k, True)) or not n.get((k, False))]
        dealt = told.withColumn("copy", F.explode(F.sequence(F.lit(0), spread - 1))).withColumn("part", F.expr(f"pmod(shiftright(h, 2) + copy, {parts})"))
        dealt = dealt.select("kind", "value", "after", "h", "part", (~F.col("held") | F.col("kind").isin(both)).alias("learned"), (F.col("held") | F.col("kind").isin(both)).alias("kept"))
        dealt = dealt.repartition(parts, "part").persist(StorageLevel.DISK_ONLY)
        net = untrained(np.random.default_rng(SEED))
        rounds = max(LEAST_ROUNDS, EPOCHS // parts)
        for turn in range(rounds):
            got = sorted(dealt.mapInArrow(lambda it, net=net, turn=turn: _train_parts(it, net, turn, rounds), "part long, n long, weights array<double>").collect())
            weights = np.average([r["weights"] for r in got], axis=0, weights=[r["n"] for r in got])
            net = _unpacked(weights)
        bins = np.zeros((2, BINS))
        for r in dealt.mapInArrow(lambda it, net=net: _count_outputs(it, net), "label int, bin int, n long").groupBy("label", "bin").agg(F.sum("n").alias("n")).collect():
            bins[r["label"], r["bin"]] = r["n"]
    finally:
        told.unpersist()
        if dealt is not None:
            dealt.unpersist()
    low = np.linspace(-EDGE, EDGE, BINS, endpoint=False)
    calibrate(net, np.tile(low + EDGE / BINS, 2), np.repeat([0.0, 1.0], BINS), (bins / bins.sum(axis=1, keepdims=True)).ravel())
    # as high as recall allows: the low edge of the bin that has the first value asked for
    upto = bins[1].cumsum()
    edge = low[np.searchsorted(upto, int((1 - RECALL) * upto[-1]), side="right")]
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.scale * edge + net.shift, -40, 40))))
    return net


def _unpacked(weights: np.ndarray) -> Network:
    sizes = [(CLASSES, CHANNELS), (CHANNELS * REACH, FILTERS), (FILTERS,), (FILTERS,), (1,)]
    ends = np.cumsum([int(np.prod(x)) for x in sizes])
    return Network(*(w.reshape(x) for w, x in zip(np.split(weights, ends[:-1]), sizes)))


def _train_parts(batches: Iterator[pa.RecordBatch], net: Network, turn: int, rounds: int) -> Iterator[pa.RecordBatch]:
    """part, n, weights: each part's own network after it has gone on from ``net`` over its examples."""
    for part, words, values, around in _by_part(batches, ("learned", "learned")):
        random = np.random.default_rng([SEED, turn, part])
        x, y = part_examples(words, values, around, turn, random, len(words) // VALUE_EACH)
        if not 0 < y.sum() < len(y):
            continue
        own = Network(*(getattr(net, k).astype(np.float32) for k in NAMES))
        step(own, x, y, random.permutation(len(x)), Moments(), BATCH if len(x) < PART_ROWS // 4 else PART_BATCH, RATE * (1 - turn / rounds), float((y < 1).sum() / y.sum()))
        weights = np.concatenate([getattr(own, k).ravel() for k in NAMES])
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n": pa.array([len(x)], pa.int64()), "weights": pa.array([weights], pa.list_(pa.float64()))})


def _count_outputs(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    """label, bin, n of the outputs of what is held back."""
    for part, words, values, around in _by_part(batches, ("kept", "kept")):
        x, y = part_examples(words, values, around, 0, np.random.default_rng([SEED, part]), len(words) // VALUE_EACH)
        z = np.concatenate([net.forward(x[k : k + 256])[0] for k in range(0, len(x), 256)]) if len(x) else np.zeros(0)
        at = np.clip((z + EDGE) * (BINS / (2 * EDGE)), 0, BINS - 1).astype(np.int64)
        kinds, n = np.unique(y.astype(np.int64) * BINS + at, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(kinds // BINS, pa.int32()), pa.array(kinds % BINS, pa.int32()), pa.array(n, pa.int64())], ["label", "bin", "n"])


def _scan(piece: pa.RecordBatch, net: Network | None) -> list[list[tuple[int, int, str]]]:
    """All findings of each text, in order."""
    texts = piece.column("text")
    spans = _patterns(texts)
    if net:
        added: dict[int, list[tuple[int, int]]] = {}
        for i, a, b in network_spans(texts.to_pylist(), net):
            added.setdefault(i, []).append((a, b))
        for i, found in added.items():  # those that touch no finding: both in order of start, ends so far at most
            own = sorted(spans[i])
            starts, ends = [x[0] for x in own], list(accumulate((x[1] for x in own), max))
            for a, b in found:
                k = bisect_left(starts, b)
                if not k or ends[k - 1] <= a:
                    spans[i].append((a, b, "network"))
    return [sorted(s, key=lambda x: (x[0], KINDS.index(x[2]), x[1])) for s in spans]


def _report(batches: Iterator[pa.RecordBatch], net: Network | None) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        found = _scan(piece, net)
        written = [[f"{k}:{a}:{b}" for a, b, k in s] for s in found]
        base = [",".join(x for x in s if not x.startswith(KINDS[-1])) for s in written]
        counts = [pa.array([sum(x[2] == k for x in s) for s in found], pa.int64()) for k in KINDS[:-1]]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *counts, pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()), pa.array([",".join(s) for s in written], pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each row; spans are kind:start:end in code points.

    Null and empty texts have none. Without labelled findings, or nothing but them, there is no network and the
    patterns' findings are all. Repeated rows are scanned one by one; an empty table gives no rows; other columns
    are not looked at.
    """
    net = docs.sparkSession.sparkContext.broadcast(learn(docs, text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _report(it, net.value), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each finding in the text replaced by a mark, overlapping ones together; all else as it was."""
    net = docs.sparkSession.sparkContext.broadcast(learn(docs, text))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            out, row = column.to_pylist(), 0
            for piece in slices(iter([pa.RecordBatch.from_arrays([column], ["text"])])):
                for spans in _scan(piece, net.value):
                    if spans:
                        body, done, kept = out[row], 0, []
                        for a, b, _ in spans:
                            if a >= done:
                                kept += [body[done:a], mark]
                            done = max(done, b)
                        out[row] = "".join([*kept, body[done:]])
                    row += 1
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, column.type))

    return docs.mapInArrow(cut, docs.schema)
