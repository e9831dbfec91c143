"""A bounded filter for key sets that are too large to broadcast.

A key's hash names one of ``BITS`` bits. The set of the keys' bits is kept as 64-bit words, at most
``BITS / 64`` rows of two numbers (about a million rows and 16 MB), however many keys there are, and is
broadcast to the scan of the large table. Rows whose bit is not set belong to no key and go there, before
anything is combined or shuffled; of the rows of other keys about ``keys / BITS`` slip through, so
whoever uses it still joins or filters by the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
# Beyond this the filter lets through more than two rows of five, and is not worth its broadcast.
MAX_KEYS = BITS // 2


def _bit(key: Column | str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_words(keys: DataFrame, on: str, bits: int = BITS) -> DataFrame:
    """``word, set_bits``: the words of the filter that have a bit set; combined per task first."""
    bit = _bit(on, bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))
    return (
        keys.filter(F.col(on).isNotNull())
        .groupBy(F.floor(bit / 64).alias("word"))
        .agg(F.bit_or(one).alias("set_bits"))
    )


def sifted(rows: DataFrame, words: DataFrame, on: str, bits: int = BITS) -> DataFrame:
    """The rows whose key's bit is set; rows without a key go."""
    bit = _bit(on, bits)
    words = words.select(F.col("word").alias("sift_word"), "set_bits")
    kept = rows.filter(F.col(on).isNotNull()).join(F.broadcast(words), F.floor(bit / 64) == F.col("sift_word"))
    place = F.pmod(bit, F.lit(64)).cast("int")
    return kept.filter(F.getbit("set_bits", place) == 1).select(*rows.columns)
