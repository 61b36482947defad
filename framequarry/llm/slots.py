"""A table of bits of a fixed size that says which hashes can be in a set; it may say yes too often, never no wrongly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a table, whatever the size of the set: a full table filters nothing and the join behind it does all the work.
SLOTS = 1 << 23


def slot_table(df: DataFrame, hashed: Column) -> np.ndarray:
    """One byte per eight slots; at most SLOTS / 64 rows come to the driver."""
    slot = hashed.bitwiseAND(F.lit(SLOTS - 1))
    words = (
        df.select(slot.alias("slot")).groupBy(F.expr("slot >> 6").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(slot & 63)))").alias("bits")).toPandas()
    )
    table = np.zeros(SLOTS // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table.view(np.uint8)


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes & hashes.dtype.type(SLOTS - 1)).astype(np.int64)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
