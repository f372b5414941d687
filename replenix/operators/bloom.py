"""Bloom-guarded anti joins (J5, J6): keys that are certainly absent are settled without meeting the other side.

The filter is an aggregate: every key sets a few bits, words of 64 bits are merged by OR (map-side first), and the words
make one array of a size that follows from the number of keys and the error rate.  A filter beyond ``MOST_BITS`` is not
built, so the array that every task holds is bounded; the exact join then does all the work.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.operators import mrp

MOST_BITS = 1 << 27   # 16 MB


@dataclass
class Bloom:
    words: Column   # the words of the filter, one scalar value
    bits: int
    hashes: int

    def may_hold(self, key: str) -> Column:
        """False only for keys that are certainly not among those of the filter; null for a null key."""
        out = F.lit(True)
        for place in _places(key, self.bits, self.hashes):
            out = out & (F.get(self.words, _word(place).cast("int")).bitwiseAND(_bit(place)) != 0)
        return F.when(F.col(key).isNotNull(), out)


def _places(key: str, bits: int, hashes: int) -> list[Column]:
    one, two = F.xxhash64(key), F.xxhash64(F.col(key), F.lit(1))
    # two hashes make all of them; shifted, so that their sums stay within 64 bits
    return [F.pmod(F.shiftright(one, 8) + F.lit(i) * F.shiftright(two, 8), F.lit(bits)) for i in range(hashes)]


def _word(place: Column) -> Column:
    return F.shiftright(place, 6)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


def build(keys: DataFrame, key: str, error: float = 0.01) -> Bloom | None:
    """The filter of the keys, or None where it would be larger than ``MOST_BITS``."""
    n = max(1, keys.count())
    bits = -(-math.ceil(-n * math.log(error) / math.log(2) ** 2) // 64) * 64
    if bits > MOST_BITS:
        return None
    hashes = max(1, round(bits / n * math.log(2)))
    places = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(key, bits, hashes))).alias("p"))
    set_bits = places.select(_word(F.col("p")).alias("word"), _bit(F.col("p")).alias("bits"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    merged = set_bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).unionByName(every)
    merged = merged.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = merged.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))
    return Bloom(words.scalar(), bits, hashes)


def dropped_skus(demand: DataFrame, stock: DataFrame, products: DataFrame, preferred: DataFrame, suppliers: DataFrame,
                 period: str = DEFAULT_PERIOD, error: float = 0.01) -> DataFrame:
    """``mrp.dropped_skus`` with the demand split by a filter of the known products: what is certainly unknown has its
    reason at once, the rest goes through the exact joins."""
    known = build(products.select("sku"), "sku", error)
    if known is None:
        return mrp.dropped_skus(demand, stock, products, preferred, suppliers, period)
    maybe = F.coalesce(known.may_hold("sku"), F.lit(True))   # a null SKU is left to the joins
    absent = demand.where(~maybe).select(period, "sku", F.lit("missing_product").alias("reason"))
    return absent.unionByName(mrp.dropped_skus(demand.where(maybe), stock, products, preferred, suppliers, period))
