"""A Bloom filter of ids with a fixed size, to thin out rows before a join
without a shuffle. It lets all ids of the set pass and few others; the join
after it decides."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25  # 4 MB


def places(name: str) -> Column:
    """The two bits of an id."""
    return F.array(*(F.pmod(F.xxhash64(F.lit(salt), F.col(name)), F.lit(BITS)) for salt in (1, 2)))


def id_filter(ids: DataFrame, name: str) -> np.ndarray:
    """The bits, as 64-bit words; at most BITS / 64 rows are collected."""
    bit = ids.select(F.explode(places(name)).alias("bit"))
    words = bit.groupBy(F.expr("bit div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("bits")
    ).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def passing(bits: np.ndarray, spots: pa.Array) -> np.ndarray:
    """Whether each row's ``places`` are all set."""
    spot = spots.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
    held = (bits[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1)
    return held.all(axis=1)
