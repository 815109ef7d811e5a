"""A bitmap of fixed size over 64-bit keys: tasks test keys before anything is shuffled.

It lets some other keys through, so an exact join on the keys must follow.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 24  # 2 MB, whatever the number of keys


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of all values of column ``gram``: at most 2**FILTER_BITS / 64 numbers are read."""
    slot = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    found = keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def present(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    slot = key >> np.uint64(64 - FILTER_BITS)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
