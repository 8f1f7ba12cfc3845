"""Quality rules on repetition within a text, by suffix arrays over its words.

The suffixes of all texts of a piece are sorted together by prefix doubling, with the text as the first key, so each
text has its own stretch of the array. The longest common prefix of neighbours, found from the ranks of each
doubling, gives for every word the longest repeat that starts there: the maximal repeated substrings. Their spans are
united; a text fails if they cover too much of it or one is too long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices, words

#: Repeats of fewer words are not counted; a text keeps up to this share of its words in repeats, and repeats of
#: this many words.
LEAST_REPEAT, MOST_COVERED, LONGEST_REPEAT = 8, 0.2, 60
#: The base rules: fewer words fail, and more than this share of words in repeated windows of three.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = r"[#*$%&|<>]"


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): rank counts the smaller distinct keys."""
    order = np.argsort(keys, kind="stable")
    new = np.zeros(len(keys), np.int64)
    new[1:] = keys[order][1:] != keys[order][:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def repeats(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word, how many words the longest substring that starts there and is found again in its text has."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    left = starts[1:][owner] - np.arange(n)  # words to the text's end
    _, rank = _dense(owner * (int(codes.max()) + 1) + codes)
    ranks, step = [rank], 1
    # until the suffixes that are left to tell apart are none
    while True:
        times = np.bincount(rank)
        tied = np.flatnonzero((times[rank] > 1))
        if not len(tied):
            break
        after = np.where(left[tied] > step, rank[np.minimum(tied + step, n - 1)] + 1, 0)
        order = np.lexsort((after, rank[tied]))
        first, second = rank[tied][order], after[order]
        head = np.ones(len(tied), bool)
        head[1:] = first[1:] != first[:-1]
        new = head.copy()
        new[1:] |= second[1:] != second[:-1]
        # a rank is the number of suffixes before its group, so splits of one group leave the others as they are
        if step == 1:
            place = np.cumsum(times) - times
            rank = place[rank]
            ranks[0] = rank
            first = rank[tied][order]
        at = np.arange(len(tied))
        begin = np.maximum.accumulate(np.where(head, at, 0))
        within = np.maximum.accumulate(np.where(new, at, 0)) - begin
        rank = rank.copy()
        rank[tied[order]] = first + within
        ranks.append(rank)
        step *= 2
    suffixes = np.argsort(rank, kind="stable")
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    same = owner[a] == owner[b]
    common = np.zeros(n - 1, np.int64)
    end_a, end_b = a + left[a], b + left[b]
    for k in range(len(ranks) - 1, -1, -1):
        size = 1 << k
        fits = same & (a + size <= end_a) & (b + size <= end_b)
        i, j = np.minimum(a, n - 1), np.minimum(b, n - 1)
        fits &= ranks[k][i] == ranks[k][j]
        common += size * fits
        a += size * fits
        b += size * fits
    longest = np.zeros(n, np.int64)
    longest[suffixes[:-1]] = common
    longest[suffixes[1:]] = np.maximum(longest[suffixes[1:]], common)
    return longest


def covered(longest: np.ndarray, starts: np.ndarray, least: int = LEAST_REPEAT) -> np.ndarray:
    """Number of words of each text in the union of repeats of ``least`` words or more."""
    edge = np.zeros(len(longest) + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    edge[at] += 1
    np.add.at(edge, at + longest[at], -1)
    inside = np.cumsum(edge)[:-1] > 0
    return np.diff(np.concatenate([[0], np.cumsum(inside)])[starts])


def _repeat_words(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of words in three-word windows that the text has twice or more."""
    n = len(codes)
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    hit = np.zeros(n + 3, bool)
    if n >= 3:
        _, pair = _dense(codes[:-1] * (int(codes.max()) + 1) + codes[1:])
        ok = owner[: n - 2] == owner[2:]
        at = np.flatnonzero(ok)
        _, triple = _dense(pair[at] * (int(codes.max()) + 1) + codes[at + 2])
        _, own = _dense(triple * len(sizes) + owner[at])
        again = at[np.bincount(own)[own] > 1]
        for k in range(3):
            hit[again + k] = True
    return np.diff(np.concatenate([[0], np.cumsum(hit[:n])])[starts])


def _same_lines(texts: pa.Array) -> np.ndarray:
    """Number of lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    worded = np.flatnonzero(pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False))
    codes = flat.take(pa.array(worded)).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keys = codes * (len(sizes) + 1) + owner[worded]
    _, first = np.unique(keys, return_index=True)
    return np.bincount(owner[worded], minlength=len(sizes)) - np.bincount(owner[worded[first]], minlength=len(sizes))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        texts = piece.column("text")
        vocabulary, codes, starts = words(texts)
        sizes = np.diff(starts)
        lengths = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        chars = np.diff(np.concatenate([[0], np.cumsum(lengths[codes])])[starts])
        symbols = pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)
        lines = _same_lines(texts)
        thrice = _repeat_words(codes, starts)
        longest = repeats(codes, starts)
        share = covered(longest, starts) / np.maximum(sizes, 1)
        most = np.zeros(len(piece), np.int64)
        if len(codes):
            np.maximum.at(most, np.repeat(np.arange(len(sizes)), sizes), longest)
        failed = (sizes < LEAST_WORDS) | (100 * thrice > MOST_REPEATED * sizes)
        kept = ~failed & (share <= MOST_COVERED) & (most <= LONGEST_REPEAT)
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (sizes, chars, symbols, lines, thrice)), pa.array(failed), pa.array(kept), pa.array(share), pa.array(most)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered", "longest_repeat"])


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, covered (share of words
    in repeats), longest_repeat of each row. Null and empty texts have no words and fail. Repeated rows are judged
    one by one; an empty table gives no rows; other columns are not looked at."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_judge, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, covered double, longest_repeat long")
