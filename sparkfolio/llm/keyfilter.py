"""A bounded filter of 64-bit keys for the large side of a join.

It is a Bloom filter of at most MAX_BYTES whatever the number of keys: it never
rejects a key that was put in, and with more keys it lets more others through,
which the join then drops.  It saves shuffling and decides nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.textarrays import mix

MAX_BYTES = 16 << 20
BITS_PER_KEY = 12
PROBES = 3


class KeyFilter:
    def __init__(self, n_bits: int, words: np.ndarray, bits: np.ndarray):
        self.n_bits = n_bits
        self.words = np.zeros(n_bits // 64, np.uint64)
        self.words[words] = bits.view(np.uint64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        h = mix(keys.view(np.uint64))
        out = np.ones(len(keys), bool)
        for i in range(PROBES):
            at = (h >> np.uint64(20 * i)) % np.uint64(self.n_bits)
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def key_filter(keys: DataFrame, column: str) -> KeyFilter:
    """The filter of a long column (nulls left out): bits are set per 64-bit
    word on the executors and reach the driver as at most MAX_BYTES."""
    n = keys.count()
    n_bits = 1 << max(6, min(MAX_BYTES * 8, max(1, n * BITS_PER_KEY)).bit_length() - 1)

    @F.pandas_udf("array<long>")
    def places(k: pd.Series) -> pd.Series:
        h = mix(k.to_numpy(np.int64).view(np.uint64))
        at = np.stack([(h >> np.uint64(20 * i)) % np.uint64(n_bits) for i in range(PROBES)], 1).astype(np.int64)
        return pd.Series(list(at))

    bits = (keys.where(F.col(column).isNotNull()).select(F.explode(places(column)).alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("bits"))).toPandas()
    return KeyFilter(n_bits, bits["word"].to_numpy(np.int64), bits["bits"].to_numpy(np.int64))


def maybe_in(shared, key: Column) -> Column:
    """Whether a long column may be among the keys of a broadcast filter (null: no)."""
    @F.pandas_udf("boolean")
    def test(k: pd.Series) -> pd.Series:
        return pd.Series(shared.value(k.to_numpy(np.int64)))

    return F.when(key.isNotNull(), test(F.coalesce(key, F.lit(0)))).otherwise(False)
