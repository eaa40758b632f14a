"""A Bloom filter over keys, built and tested with Spark's own expressions.

A join with few keys shuffles the whole other side when the keys are too many to broadcast. A filter
of bounded size over these keys goes to all tasks instead, as the value of a scalar subquery, and
leaves out nearly all rows without a match before anything is shuffled. It never leaves out a row
with a match; what it lets through is joined as before. Too many keys for its size let everything
through, which costs no more than the join alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (128 KiB: at 100,000 keys 3 % of other rows pass) and places looked at per key.
BITS, PROBES = 1 << 20, 2
_WORD = 6


def key_filter(keys: DataFrame, bits: int = BITS) -> Column:
    """The filter of a frame of one column, as an array of 64-bit words."""
    key = keys.columns[0]
    places = F.explode(F.array(*[_place(F.col(key), n, bits) for n in range(PROBES)]))
    words = (
        keys.where(F.col(key).isNotNull())
        .select(places.alias("place"))
        .groupBy(F.shiftright("place", _WORD).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("bits"))
    )
    # Every word of the filter, in order; there are as many as it has words, whatever the keys.
    every = keys.sparkSession.range(bits >> _WORD).select(F.col("id").alias("word"))
    filled = every.join(words, "word", "left").select(
        F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("entry")
    )
    in_order = F.array_sort(F.collect_list("entry"))
    return filled.agg(F.transform(in_order, lambda entry: entry["bits"])).scalar()


def may_hold(words: Column, key: Column, bits: int = BITS) -> Column:
    """False only where the key is not among those of the filter; a NULL key is not."""
    found = F.lit(True)
    for n in range(PROBES):
        place = _place(key, n, bits)
        word = F.get(words, F.shiftright(place, _WORD).cast("int"))
        found = found & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return key.isNotNull() & found


def _place(key: Column, probe: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("long"), F.lit(probe)), F.lit(bits)).cast("long")
