"""Packing of documents into token sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are dealt at random into groups of bounded size; each group is packed by itself in one task. What a
document has beyond full sequences goes first-fit into bins; then the emptiest bins are cut up to fill the others,
and the one that remains is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import os
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .store import saved
from .text import ragged, slices, strings, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE = 4096
#: The id that ends a document.
END = 2
#: Documents and bytes of text of a group, on average.
GROUP, GROUP_BYTES = 1024, 8 << 20
#: Rows of one id and text that go to one group; more of them are dealt by the partition that they are read in.
EQUAL_ROWS = 64
#: Such pairs of id and text that are broadcast at most; more of them are joined.
BROADCAST_ROWS = 100_000
#: Words whose ids a worker keeps.
KEPT_WORDS = 100_000
MARKS = ".,;:!?"
#: Letters below this one are still letters after the tokenizer's normalisation, so what follows them is parted from them.
PLAIN = "\u0130"
#: A mark that is one token; words with it are encoded one by one, others together with the mark between them.
MARK = "~"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@cache
def _tokenizer(path: str) -> tuple[Tokenizer, dict[str, bytes]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
    return Tokenizer.from_file(path), {}


@cache
def _ends(path: str) -> np.ndarray:
    """Whether each id ends a run of letters, digits or marks."""
    vocabulary = _tokenizer(path)[0].get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return out


def _encode(tokenizer: Tokenizer, names: list[str], path: str) -> dict[str, bytes]:
    """The ids of each word, as bytes. Words of letters alone are one run each, so the ids that end a run part them;
    other words are encoded with a mark between them."""
    encode = lambda text: np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
    out = {w: encode(w).tobytes() for w in names if MARK in w}
    plain = [w for w in names if w.isalpha() and max(w) < PLAIN]
    other = [w for w in names if MARK not in w and not (w.isalpha() and max(w) < PLAIN)]
    (mark,) = encode(MARK)
    for rest, joint in ((plain, " "), (other, f" {MARK} ")):
        for k in range(0, len(rest), 16_384):
            part = rest[k : k + 16_384]
            ids = encode(joint.join([*part, ""]))
            if joint == " ":
                ends = np.flatnonzero(_ends(path)[ids]) + 1
                starts = np.concatenate([[0], ends[:-1]])
            else:
                ends = np.flatnonzero(ids == mark)
                starts = np.concatenate([[0], ends[:-1] + 1])
            if len(ends) != len(part):  # a word that is several runs after all
                out.update((w, encode(w).tobytes()) for w in part)
                continue
            flat = ids.tobytes()
            out.update((w, flat[4 * a : 4 * b]) for w, a, b in zip(part, starts.tolist(), ends.tolist()))
    return out


def token_ids(texts: pa.Array, path: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each text's ids start, one more than texts). The tokenizer drops white space and
    no token goes across it, so a word's ids don't depend on its neighbours and each distinct word is encoded once."""
    tokenizer, known = _tokenizer(path)
    # the tokenizer lower-cases too, but takes its special tokens from the text as it is
    special = pc.any(pc.match_substring(texts, "<|")).as_py()
    vocabulary, codes, starts = words(texts, lower=not special)
    # a mark after a plain letter is a token of its own, so the word before it is the same word
    split = [(w[:-1], w[-1]) if w[-1] in MARKS and w[-2:-1].isalpha() and w[-2] < PLAIN else (w, "") for w in strings(vocabulary)]
    fresh = _encode(tokenizer, list({w for w, _ in split if w not in known}.union(m for m in MARKS if m not in known)), path)
    if len(known) < KEPT_WORDS:
        known.update(fresh)
        fresh = known
    marks = {"": b"", **{m: known[m] if m in known else fresh[m] for m in MARKS}}
    parts = [(known[w] if w in known else fresh[w]) + marks[m] for w, m in split]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    pool = np.frombuffer(b"".join(parts), "<u4")
    at = np.cumsum(sizes) - sizes
    each = sizes[codes]
    return pool[ragged(at[codes], each)], np.concatenate([[0], np.cumsum(each)])[starts]


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, taken in the order given: the first bin that has room.

    A tournament tree keeps in each node the largest room below it, so the first bin is found from the root down.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = []
    for size in sizes:
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < size:
                k += 1
        bins.append(k - leaves)
        room[k] -= size
        k //= 2
        while k:
            room[k] = max(room[2 * k], room[2 * k + 1])
            k //= 2
    return bins


def pack(sizes: list[int], capacity: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces that hold each document of the sizes once, without padding but
    for sequences whose length is a power of two."""
    out, rest = [], []
    for doc, size in enumerate(sizes):
        full = size // capacity
        out += [[(doc, k * capacity, capacity)] for k in range(full)]
        if size % capacity:
            rest.append((doc, full * capacity, size % capacity))
    rest.sort(key=lambda x: (-x[2], x[0]))
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for piece, k in zip(rest, first_fit([x[2] for x in rest], capacity)):
        bins.setdefault(k, []).append(piece)
    loose = []
    for k in sorted(bins):
        used = sum(x[2] for x in bins[k])
        (out if used & (used - 1) == 0 else loose).append(bins[k])
    loose.sort(key=lambda b: -sum(x[2] for x in b))
    while len(loose) > 1:  # the emptiest fills the fullest
        filled, giver = loose[0], loose[-1]
        room = capacity - sum(x[2] for x in filled)
        doc, start, size = giver.pop()
        if size > room:
            giver.append((doc, start, size - room))
            start, size = start + size - room, room
        filled.append((doc, start, size))
        if size == room:
            out.append(loose.pop(0))
        if not giver:
            loose.pop()
    for pieces in loose:
        left = sum(x[2] for x in pieces)
        pieces = pieces[::-1]
        while left:
            most, sequence = 1 << (left.bit_length() - 1), []
            left -= most
            while most:
                doc, start, size = pieces.pop()
                take = min(size, most)
                sequence.append((doc, start, take))
                most -= take
                if size > take:
                    pieces.append((doc, start + take, size - take))
            out.append(sequence)
    return out


def _pack_group(table: pa.Table) -> pa.Table:
    table = table.sort_by([("doc_id", "ascending"), ("t", "ascending")])  # rows equal in both are the same
    ids: list[np.ndarray] = []
    for piece in slices(table.select(["text"]).combine_chunks().to_batches()):
        flat, starts = token_ids(piece.column("text"))
        ids += [np.append(flat[a:b], np.uint32(END)).astype("<u4") for a, b in zip(starts[:-1], starts[1:])]
    rows = []
    for k, sequence in enumerate(pack([len(x) for x in ids])):
        offset = 0
        for doc, start, size in sequence:
            rows.append((doc, start, size, zlib.crc32(ids[doc][start : start + size].tobytes()), len(ids[doc]), k, offset))
            offset += size
    doc, *rest = (np.array(x, np.int64) for x in zip(*rows))
    group = table.column("group")[0].as_py()
    start, size, crc, total, sequence, offset = rest
    return pa.table({"doc_id": table.column("doc_id").take(pa.array(doc)), "start": start, "length": size, "ids_crc32": crc, "doc_tokens": total, "sequence_id": (group << 32) + sequence, "offset": offset})


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", group: int = GROUP) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text has the end id alone. Repeated rows are documents of their own; a null id stays null. Rows are
    dealt to groups by id and text, so reruns agree and a lost task's rows are dealt as before; of an id and text in more
    than ``EQUAL_ROWS`` rows, those of one input partition go together and other partitions elsewhere. A text of any
    length is held by one task whole. An empty table gives no rows; other columns are not looked at.
    """
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    n, size = whole.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    groups = max(1, -(-n // group), -(-(size or 0) // GROUP_BYTES))
    dealt = whole.withColumn("many", F.lit(False))
    equal = saved(whole.groupBy("doc_id", "t").count().where(F.col("count") > EQUAL_ROWS).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t")))
    if held := equal.count():
        equal = F.broadcast(equal) if held <= BROADCAST_ROWS else equal
        found = whole.withColumn("part", F.spark_partition_id()).join(equal, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("t")), "left")
        dealt = found.withColumn("many", F.col("_t").isNotNull())
    part = F.when(F.col("many"), F.col("part") if held else F.lit(0))
    dealt = dealt.select("doc_id", "text", "t", F.pmod(F.xxhash64("doc_id", "t", part), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInArrow(_pack_group, PIECES)
