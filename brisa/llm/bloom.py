"""A Bloom filter over 64-bit keys, built by Spark, at most :data:`MOST_BITS` large.

It only keeps rows from being shuffled in vain: a false positive costs a row and never changes a result,
and past the size bound the share of such rows grows while results stay the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS, BITS_PER_KEY = 1 << 16, 1 << 28, 16


def build(keys: DataFrame, column: str, count: int) -> np.ndarray:
    """64-bit words of the filter over a long column; ``count`` is how many keys there are."""
    bits = LEAST_BITS
    while bits < min(count * BITS_PER_KEY, MOST_BITS):
        bits *= 2
    log = bits.bit_length() - 1
    key = F.col(column)
    probes = F.array(*[F.shiftrightunsigned(key, 64 - log - shift).bitwiseAND(F.lit(bits - 1)) for shift in (0, 20)])
    found = (
        keys.select(F.explode(probes).alias("bit"))
        .groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(bits >> 6, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return words


def contains(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter (surely all that are)."""
    keys = keys.view(np.uint64)
    bits = len(words) << 6
    log = bits.bit_length() - 1
    out = np.ones(len(keys), bool)
    for shift in (0, 20):
        bit = (keys >> np.uint64(64 - log - shift)) & np.uint64(bits - 1)
        out &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out
