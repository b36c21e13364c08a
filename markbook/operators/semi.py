"""JN8 / JN9: semi joins of the price fact with a set of tickers, with a Bloom filter in the scan stage.

When the set is too large to broadcast, a semi join moves every price row by ticker, also the rows of
tickers nobody holds, and a hot ticker lands in one task.  Here the set is first folded into a filter of fixed
size by one aggregation, and the price rows are tested against it where they are read; only rows that
pass move to the exact semi join.

The filter is blocked: a key's hash chooses one of ``words`` 64-bit words and three bits in it, so the filter is a
table (word, bits) of at most ``words`` rows, whatever the set's size, and testing a row is one broadcast
hash lookup.  No key of the set is ever missed; with more keys than it is made for, more other rows pass and
the exact join drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 17  # 2 MB of (word, bits); one row in a thousand passes by mistake at about 400,000 keys
BITS_PER_KEY = 3


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: str) -> Column:
    # a second hash, so that the bits do not depend on the word
    h = F.xxhash64(F.col(key), F.lit(1))
    one = F.lit(1).cast("bigint")
    out = None
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def bloom_filter(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """(word, bits) of the keys, at most ``words`` rows; NULL keys are left out."""
    return (keys.where(F.col(key).isNotNull()).select(_word(key, words).alias("word"), _bits(key).alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")))


def may_be_in(rows: DataFrame, keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """The rows whose key passes the filter of ``keys``: all that are in the set, and few others."""
    f = F.broadcast(bloom_filter(keys, key, words)).alias("f")  # bounded: at most ``words`` rows
    mask = _bits(key)
    return rows.join(f, (_word(key, words) == F.col("f.word")) & (F.col("f.bits").bitwiseAND(mask) == mask), "left_semi")


def semi_join(rows: DataFrame, keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``rows`` whose key is in ``keys``, exactly."""
    return may_be_in(rows, keys, key, words).join(keys.select(key), key, "left_semi").select(*rows.columns)
