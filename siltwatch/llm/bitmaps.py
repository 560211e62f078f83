"""Sets of ids as bitmaps of bounded size, for tests beside a scan.

A bitmap never misses an id of its set; it may hit others, so whoever uses it checks
again or can do with more. It has 64 bits an id up to a bound that does not depend on
the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE_BITS = 32
"""A place is a number of so many bits; a smaller bitmap uses the upper ones."""
FEWEST_BITS = 15
_PER_BUCKET = 1 << 15


def bitmap(df: DataFrame, place: str | Column, most_bits: int) -> np.ndarray:
    """Places that occur in a written table, as at most 2 ** ``most_bits`` bits."""
    bits = min(most_bits, max(FEWEST_BITS, (64 * df.count()).bit_length()))
    upper = F.shiftright(F.col(place) if isinstance(place, str) else place, PLACE_BITS - bits)
    at = upper + 1  # the functions count from 1
    bucket, bit = F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at)
    cells = df.groupBy(bucket).agg(F.bitmap_construct_agg(bit).alias("bits")).collect()  # 2 ** bits bits at most
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for bucket_no, data in cells:
        start = (bucket_no - 1) * _PER_BUCKET // 8
        out[start : start + _PER_BUCKET // 8] = np.frombuffer(data, dtype=np.uint8)
    return out


def has(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places are set."""
    upper = places >> (PLACE_BITS - (8 * len(bits)).bit_length() + 1)
    return (bits[upper >> 3] >> (upper & 7).astype(np.uint8)) & 1 == 1


def id_place(key: str) -> Column:
    """Place of an id."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - PLACE_BITS)
