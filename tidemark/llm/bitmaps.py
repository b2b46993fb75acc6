"""A bitmap of fixed size that tells tasks which keys to skip.

It only spares work: a key that is in the set always hits, and keys that hit by chance are removed later by a join. So
results do not depend on its size, and it takes the same few megabytes whatever the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits. Far from dividing 2^33, the step of row keys between splits.
SIZE = 59_999_999


def bitmap_of(keys: DataFrame, name: str) -> np.ndarray:
    """Bits of a column of longs, each modulo `SIZE`; summed up by words before they reach the driver."""
    bit = F.pmod(F.col(name), F.lit(SIZE))
    words = (
        keys.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({name}, {SIZE}L) % 64 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(SIZE // 64 + 1, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (int64) may be in the set."""
    place = keys % SIZE
    return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


#: Bits of the largest bitmap that `sized_bitmap` makes: 32 MB. Beyond 16 million keys it lets more and more others pass.
MOST_BITS = 1 << 28
BITS_PER_KEY = 16


def sized_bitmap(keys: DataFrame, name: str, count: int) -> np.ndarray:
    """Bits of a column of longs with `count` keys, 16 or more bits a key up to `MOST_BITS`."""
    size = min(MOST_BITS, 1 << max(16, (BITS_PER_KEY * count - 1).bit_length()))
    bit = F.col(name).bitwiseAND(F.lit(size - 1))
    words = (
        keys.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast({name} & 63L as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(size >> 6, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def hits_sized(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (uint64) may be in the set of `sized_bitmap`."""
    place = keys & np.uint64(64 * len(bits) - 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
