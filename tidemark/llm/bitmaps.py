"""Bitmaps of keys: a filter of fixed size that passes all its keys and, while it isn't full, few others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The bits of a bitmap, as a power of two: at least for few keys, and at most, 16 MB, for any number of keys.
LEAST, BITS = 15, 27


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A bitmap with two bits set for each key: some 16 bits a key, 2^bits at most. It comes to the driver in parts of 4 KB.

    keys: read twice, so a table that is written.
    """
    bits = min(bits, max(LEAST, (16 * keys.count()).bit_length()))
    key, most = F.col(column), (1 << bits) - 1
    probes = F.array(*[probe.bitwiseAND(most) + 1 for probe in (key, F.shiftrightunsigned(key, 32))])
    rows = keys.select(F.explode(probes).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("set")
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows.toLocalIterator():
        out[(row.part - 1) * 4096 : row.part * 4096] = np.frombuffer(row.set, np.uint8)
    return out


def inside(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of each key are set: of all keys that the bitmap was made of, and few others."""
    most = np.uint64(len(bits) * 8 - 1)

    def probe(x: np.ndarray) -> np.ndarray:
        return (bits[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 != 0

    found = probe(keys & most)
    found[found] = probe((keys[found] >> np.uint64(32)) & most)
    return found
