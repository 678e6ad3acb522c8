"""Probabilistic key filters: a Bloom filter built and tested with DataFrame functions.

The filter is an array of 64-bit words. A key's hash chooses one word, a second hash ``PROBES`` bits in it; the
words of all keys are combined by ``bit_or`` (summed up per task before the shuffle, at most one row per word
and task). The test reads one array element, so rows are dropped where they are read, inside the
generated code, before they reach a shuffle. A filter only ever lets too much through: an exact join follows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
BITS_PER_KEY = 12
# The array travels to every task: at most 2^26 bits, 8 MB. Beyond some 5 million keys it lets more through.
MAX_BITS = 1 << 26


def _place(on: list[str], words: int) -> tuple[Column, Column]:
    """Word and bits of a row's key."""
    h, g = F.xxhash64(*on), F.xxhash64(F.lit(1), *on)
    word = F.shiftrightunsigned(h, 64 - int(math.log2(words))).cast("int") if words > 1 else F.lit(0)
    bits = None
    for k in range(PROBES):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return word, bits


def filter_words(n_keys: int, max_bits: int = MAX_BITS) -> int:
    """Words of a filter for that many keys: a power of two."""
    bits = max(64, min(max_bits, BITS_PER_KEY * max(n_keys, 1)))
    return 1 << math.ceil(math.log2(bits / 64))


def key_filter(keys: DataFrame, on: list[str], n_keys: int, max_bits: int = MAX_BITS) -> Column:
    """A condition that holds for every row whose ``on`` columns are a key of ``keys``, and for few others.
    ``n_keys``: about how many keys there are; a null in any column is no key."""
    words = filter_words(n_keys, max_bits)
    word, bits = _place(on, words)
    present = keys.dropna(subset=on).select(word.alias("_word"), bits.alias("_bits"))
    empty = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    rows = present.unionByName(empty).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    array = rows.agg(F.array_sort(F.collect_list(F.struct("_word", "_bits")))["_bits"].alias("_filter"))  # `words` entries
    return F.get(array.scalar(), word).bitwiseAND(bits) == bits


def semi_join(df: DataFrame, keys: DataFrame, on: list[str], n_keys: int, *, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, for key sets too large to broadcast: ``df`` is thinned by a key
    filter where it is read, and only what passes is shuffled for the exact semi join."""
    thin = df.filter(key_filter(keys, on, n_keys, max_bits))
    return thin.join(keys.select(*on).distinct(), on, "left_semi")
