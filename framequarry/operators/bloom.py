"""A Bloom filter over the keys of a small frame, probed with column expressions.

It says no only to keys that are not in the frame, so rows it rejects need no look-up; a yes has to be checked by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits per key and bits set for each (about 2 % wrong yeses), and the most bits of a filter, whatever the number of keys:
#: a fuller filter rejects less and the join behind it does more.
BITS_PER_KEY, PROBES = 8, 5
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 22


class Bloom:
    """The filter as a literal array of 64-bit words; at most MOST_BITS / 64 rows come to the driver to make it."""

    def __init__(self, df: DataFrame, key: str):
        places = df.filter(F.col(key).isNotNull()).select(F.explode(F.array(*self._places(F.col(key), MOST_BITS))).alias("place"))
        words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        found = {r["word"]: r["bits"] & (2**64 - 1) for r in words.collect()}
        # Sized by the number of keys, which the bits set tell; places modulo a smaller power of two are the lower words.
        keys = sum(bits.bit_count() for bits in found.values()) // PROBES + 1
        self.bits = min(max(LEAST_BITS, 1 << (BITS_PER_KEY * keys - 1).bit_length()), MOST_BITS)
        folded = [0] * (self.bits // 64)
        for word, bits in found.items():
            folded[word % len(folded)] |= bits
        text = ",".join(str(bits - 2**64 if bits >= 2**63 else bits) for bits in folded)
        self._words = F.split(F.lit(text), ",").cast("array<bigint>")

    @staticmethod
    def _places(key: Column, size: int) -> list[Column]:
        """Two hashes make all places, as is usual for these filters."""
        a, b = F.xxhash64(key), F.xxhash64(key, F.lit(1))
        return [F.pmod(a.bitwiseAND(0xFFFFFFFF) + i * b.bitwiseAND(0xFFFFFFFF), F.lit(size)) for i in range(PROBES)]

    def may_hold(self, key: Column) -> Column:
        """False for keys that are surely not in the frame, and for NULL."""
        found = F.lit(True)
        for place in self._places(key, self.bits):
            word = F.get(self._words, F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, place.bitwiseAND(63).cast("int")) == 1)
        return F.coalesce(key.isNotNull() & found, F.lit(False))
