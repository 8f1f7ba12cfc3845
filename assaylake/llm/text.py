"""Arrow and numpy helpers that the text operators share inside their tasks.

A word is a maximal run of characters other than space and U+0009 to U+000D, as everywhere in this
subpackage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into numpy arrays at a time.
SLICE_BYTES = 4 << 20

U64 = np.uint64


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a piece holds about ``most`` bytes of ``column`` (one row at least), nulls as ''."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at), "")
        batch = batch.set_column(at, pa.field(column, texts.type), texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(batch):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, index into them of each word in order, where each text's words start, one more than texts).

    ``lower`` lower-cases A-Z and nothing else.
    """
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.concatenate([[0], np.cumsum(full)])[at]
    encoded = flat.filter(pa.array(full)).dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0x9E6D62D06F6A9A9B)
    x ^= x >> U64(29)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    padded = np.zeros(len(mask) + 2, bool)
    padded[1:-1] = mask
    edge = np.flatnonzero(padded[1:] != padded[:-1])
    return edge[::2], edge[1::2]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ... of all i, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
