"""Filters of hash keys: one bit a key, of a size that is bounded whatever the number of keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import U64

#: Bits of a filter for each key, and bits at most: a filter never grows beyond this size (16 MB), it only lets more pass.
BITS_EACH, MOST_BITS = 16, 1 << 27


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set; a filter has a power of two of bits, and a key's bit is its upper bits."""
    bit = keys >> U64(64 - (64 * len(filter_)).bit_length() + 1)
    return (filter_[(bit >> U64(6)).astype(np.int64)] >> (bit & U64(63)) & U64(1)).astype(bool)


def key_filter(keys: DataFrame, count: int) -> np.ndarray:
    """A filter of ``BITS_EACH`` bits for each of the ``count`` keys (64 hash bits in the column ``key``), ``MOST_BITS`` at most.
    Set bits are put together by Spark; the driver gets words of 64 bits, whose number the filter's size bounds."""
    size = min(MOST_BITS, 1 << max(12, (BITS_EACH * count - 1).bit_length()))
    bit = F.shiftrightunsigned("key", 64 - size.bit_length() + 1)
    bits = keys.select(bit.alias("bit")).select(F.shiftrightunsigned("bit", 6).alias("at"), F.expr("shiftleft(1L, int(bit & 63))").alias("bits"))
    rows = bits.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, U64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(U64)
    return out
