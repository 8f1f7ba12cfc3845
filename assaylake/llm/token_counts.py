"""Token counts of a byte-level BPE vocabulary: a heap of adjacent pairs by rank and a linked list of symbols.

Texts are cut into pieces as the vocabulary's pre-tokenizer cuts them, on arrays of code points; each distinct piece is
merged once: the lowest-ranked adjacent pair (of equal ones the leftmost) is popped from the heap again and again, and the
count is the number of initial symbols less the merges. Token ids of a text are never made.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .text import slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A document of more tokens is over the limit.
LIMIT = 1024
#: Pieces whose counts a worker keeps, and the bytes of the longest of them.
KEPT_PIECES, KEPT_BYTES = 200_000, 256
#: Symbols of a piece that are held in lists, which are faster; longer pieces are held in arrays, which are smaller.
LISTED = 4096
#: Bytes of text that are code points at a time.
SLICE_BYTES = 2 << 20
#: Classes of code points.
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)
#: What follows an apostrophe and is a piece with it.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _symbols() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the
    others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Merges:
    """The merge table of a vocabulary file, its special strings, and counts of the pieces met so far."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        level = cut and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        odd = [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if not plain or not level or spec["normalizer"] or odd:
            raise ValueError("a byte-level BPE without normalizer and prefix space is asked for, its special strings taken as they are")
        ids = model["vocab"]
        self.byte = [ids[s] for _, s in sorted(_symbols().items())]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: left and right id in one integer to the pair's rank; rank to merged id
        self.rank, self.merged = {}, []
        for a, b in pairs:
            self.rank[ids[a] << 32 | ids[b]] = len(self.merged)
            self.merged.append(ids[a + b])
        specials = sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, specials))) if specials else None
        self.specials = [s.decode() for s in specials]
        self.cutter = Tokenizer.from_str(file).pre_tokenizer
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        #: the latest pieces, and those of the time before
        self.counts: dict[bytes, int] = {}
        self.before: dict[bytes, int] = {}

    def learn(self, codes: np.ndarray) -> None:
        """Find the classes of code points not met before, by how the vocabulary's own pre-tokenizer cuts them."""
        new = np.unique(codes[self.classes[codes] == UNKNOWN])
        whole = lambda s: len(self.cutter.pre_tokenize_str(s)) == 1
        for c in new.tolist():
            x = chr(c)
            self.classes[c] = LETTER if whole("a" + x) else NUMBER if whole("1" + x) else OTHER if whole("!" + x) else SPACE

    def tokens(self, piece: bytes) -> int:
        """Symbols of a piece after all merges. A symbol's rank is that of the pair with the symbol after it, -1 for none."""
        n, get, merged = len(piece), self.rank.get, self.merged
        if n < 2:
            return n
        pack = list if n <= LISTED else partial(array, "q")
        symbol = pack(map(self.byte.__getitem__, piece))
        rank = pack([get(a << 32 | b, -1) for a, b in zip(symbol, symbol[1:])])
        rank.append(-1)
        after, before = pack(range(1, n + 1)), pack(range(-1, n - 1))
        heap = [r * n + k for k, r in enumerate(rank) if r >= 0]
        heapify(heap)
        left = n
        while heap:
            order, k = divmod(heappop(heap), n)
            if rank[k] != order:
                continue  # one of the two has been merged since
            left -= 1
            symbol[k] = new = merged[order]
            gone = after[k]
            after[k] = beyond = after[gone]
            rank[gone] = rank[k] = -1
            if beyond < n:
                before[beyond] = k
                rank[k] = r = get(new << 32 | symbol[beyond], -1)
                if r >= 0:
                    heappush(heap, r * n + k)
            ahead = before[k]
            if ahead >= 0:
                rank[ahead] = r = get(symbol[ahead] << 32 | new, -1)
                if r >= 0:
                    heappush(heap, r * n + ahead)
        return left

    def count(self, piece: bytes) -> int:
        found = self.counts.get(piece)
        if found is None:
            found = self.before.get(piece)
            if found is None:
                found = self.tokens(piece)
            if len(piece) <= KEPT_BYTES:
                if len(self.counts) >= KEPT_PIECES:
                    self.counts, self.before = {}, self.counts
                self.counts[piece] = found
        return found


def cuts(codes: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point. ``begins`` are the starts of texts, which nothing reaches over.

    A run of one class is a piece, and takes one space before it along. Of white space before something else the last
    character is parted from the rest. An apostrophe that begins a piece takes one of ``ENDINGS`` along.
    """
    n = len(codes)
    first = np.zeros(n + 1, bool)
    first[begins] = first[n] = True
    start = first.copy()
    start[1:n] |= kinds[1:] != kinds[:-1]
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~first[1:n])
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    marks = np.flatnonzero((codes == 0x27) & start[:n])
    for ending in ENDINGS:
        size = len(ending)
        at = marks[marks + size < n]
        same = np.ones(len(at), bool)
        for k, letter in enumerate(ending):
            same &= (codes[at + k + 1] == ord(letter)) & ~first[at + k + 1]
        at = at[same]
        start[at + 1] = False
        start[at + 1 + size] = True
    return start[:n]


def count_texts(texts: pa.Array, merges: Merges) -> np.ndarray:
    """Tokens of each text of an array without nulls."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = bytes(memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]])
    offsets = offsets - offsets[0]
    out = np.zeros(len(texts), np.int64)
    if not data:
        return out
    codes = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    merges.learn(codes)
    sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])  # where each code point's bytes are
    spans = []
    for special in merges.specials:
        for k in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
            spans += [(offsets[k] + m.start(), offsets[k] + m.end()) for m in merges.special.finditer(data[offsets[k] : offsets[k + 1]])]
    spans = np.searchsorted(at, np.array(sorted(set(spans)), np.int64).reshape(-1, 2))
    edges = np.concatenate([np.searchsorted(at, offsets[:-1]), spans.ravel()])
    start = cuts(codes, merges.classes[codes], edges[edges < len(codes)])
    for a, b in spans:
        start[a + 1 : b] = False
    begins = np.flatnonzero(start)
    ends = np.concatenate([at[begins], [len(data)]])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    each = np.array([merges.count(p) for p in pieces.dictionary.to_pylist()], np.int64)[pieces.indices.to_numpy()]
    each[np.searchsorted(begins, spans[:, 0])] = 1
    np.add.at(out, np.searchsorted(offsets, ends[:-1], side="right") - 1, each)
    return out


@cache
def _merges(file: str) -> Merges:
    return Merges(file)


def count_tokens(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """One row a document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    A null text counts as an empty one: no bytes, no tokens. Repeated rows stay, a null id stays null, and an empty table
    gives no rows; other columns are not looked at. The vocabulary's special strings within a text are one token each, as
    the library has it by default. Rows are counted where they are read, in slices of ``SLICE_BYTES``; one text is held
    by a task whole, and so is a piece of any length. The driver reads the vocabulary file, whose size is fixed, and sends it
    to the tasks; a worker keeps the counts of twice
    ``KEPT_PIECES`` pieces at most.
    """
    with open(tokenizer, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(file.value)
        for batch in slices(batches, most=SLICE_BYTES):
            n = count_texts(batch.column("text"), merges)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(n), "over_limit": pa.array(n > limit)})

    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return whole.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).mapInArrow(run, COUNTS)
