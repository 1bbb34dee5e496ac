"""A bitmap of fixed size that tells which 64-bit tokens may be in a set.

It only thins out rows before a join: a token of the set always passes, others
pass rarely while the set is small against the bitmap, and all the time once the
bitmap is full. Its size, and so what is broadcast, never exceeds ``2**MOST_BITS``
bits, whatever the size of the set.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 16, 26
_BUCKET = 32768


def build_bitmap(tokens: DataFrame, token: str, n_tokens: int) -> np.ndarray:
    """Bitmap (one bit per place, packed) of a frame of signed 64-bit tokens."""
    bits = min(max(LEAST_BITS, (max(n_tokens, 1) * 64).bit_length()), MOST_BITS)
    place = F.shiftrightunsigned(F.col(token), 64 - bits) + 1
    rows = (
        tokens.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .toLocalIterator()
    )
    packed = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows:
        first = (row["bucket"] - 1) * _BUCKET // 8
        part = np.frombuffer(bytes(row["bits"]), np.uint8)[: len(packed) - first]
        packed[first : first + len(part)] = part
    return packed


def may_contain(bitmap: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For each unsigned token, whether its bit is set."""
    bits = (len(bitmap) * 8).bit_length() - 1
    place = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
