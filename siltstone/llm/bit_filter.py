"""A filter of bounded size over 64-bit codes.

The filter is one bitmap of BITS at most, whatever the input: a code of the set always passes, others
pass with the share of bits that are set. It saves work and decides nothing: what passes is looked at
exactly. A filter of few codes is folded: the two halves of it are one of half the length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (8 MB), and of a row of Spark's bitmap functions (fixed value).
BITS, ROW_BITS = 1 << 26, 1 << 15
#: Bits of a folded filter for each that is set, at least.
SPARSE = 1024


def bitmap(codes: DataFrame, code: str) -> np.ndarray:
    """The filter of a column of codes: 2,048 rows of 4 kB reach the driver at most, whatever the input, by
    one job for all partitions."""
    place = F.col(code).bitwiseAND(F.lit(BITS - 1)) + 1
    rows = (
        codes.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = np.zeros((BITS // ROW_BITS, ROW_BITS // 8), dtype=np.uint8)
    for found in rows.collect():
        out[found.row - 1] = np.frombuffer(found.bits, dtype=np.uint8)
    return folded(out.ravel())


def folded(bits: np.ndarray) -> np.ndarray:
    """The shortest filter of a power of two of bits in which no more than one in SPARSE is set."""
    most = int(np.bitwise_count(bits.view(np.uint64)).sum(dtype=np.int64))
    while len(bits) > 8 and len(bits) * 4 >= SPARSE * most:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def passing(filter_bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which codes (unsigned 64-bit) pass."""
    place = codes & np.uint64(8 * len(filter_bits) - 1)
    bytes_ = filter_bits[(place >> np.uint64(3)).astype(np.int64)]
    return (bytes_ >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
