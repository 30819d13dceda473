"""A bit set of keys that drops most other rows before a shuffle.

``bit_set`` sets, for every key, the bit that its hash names, and gives the
bits as one row of longs: a table of bounded size, so it may be broadcast
whatever the keys.  ``prefilter`` keeps the rows whose bit is set: all rows
of the keys, and the few others that share a bit.  A join with the keys
themselves decides; it then moves the kept rows and the false hits only.

The set has about eight bits a key, up to ``MOST_BITS`` (8 MB).  Beyond 8
million keys it lets more and more through, and the join has more to do;
results don't change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS = 1 << 16
MOST_BITS = 1 << 26


def bits_for(n_keys: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (8 * n_keys).bit_length()))


def _slot(key: Column, n_bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(n_bits - 1))


def bit_set(keys: DataFrame, key_col: str, n_bits: int) -> DataFrame:
    """One row (bits array<long>) of ``n_bits`` bits."""
    slot = _slot(F.col(key_col), n_bits)
    words = (keys.select(F.shiftright(slot, 6).alias("at"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("at").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("word")))
    every = keys.sparkSession.range(n_bits // 64).withColumnRenamed("id", "at").join(words, "at", "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("long")).alias("word")))),
                                 lambda x: x["word"]).alias("bits"))


def prefilter(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None, n_bits: int | None = None) -> DataFrame:
    """The rows of ``df`` whose ``col`` may be a key of ``keys`` (a table that is
    cheap to read); a null is none."""
    key_col = key_col or col
    n_bits = n_bits or bits_for(keys.count())
    slot = _slot(F.col(col), n_bits)
    word = F.get(F.col("bits"), F.shiftright(slot, 6).cast("int"))
    hit = F.col(col).isNotNull() & (F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return df.join(F.broadcast(bit_set(keys.select(key_col), key_col, n_bits)), hit, "left_semi")
