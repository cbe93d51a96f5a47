"""A filter of fixed size that lets through every row whose key is listed, and few others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of a sieve: 2**23 are a table of at most 131,072 words, some 2 MB whatever is listed.
# With a million keys one row in nine passes unlisted.
BITS, WORD = 1 << 23, 64


def sieve(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(word, mask): a bit for the hash of each key, as many words as the bits fill at most."""
    spot = F.pmod(F.xxhash64(key), F.lit(bits))
    words = keys.where(F.col(key).isNotNull()).select(
        F.floor(spot / WORD).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (spot % WORD).cast("int")).alias("bit"),
    )
    return words.groupBy("word").agg(F.bit_or("bit").alias("mask"))


def sifted(rows: DataFrame, key: str, words: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows whose key may be listed; none that is listed is lost.

    The sieve has a fixed size, so it is broadcast and rows are dropped by the tasks that read
    them, before they are summed or moved. ``bits`` must be those the sieve was made with, and the
    key of the same type: its hash depends on it.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(bits))
    held = F.broadcast(words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask")))
    met = rows.join(held, F.floor(spot / WORD).cast("int") == F.col("_word"))
    return met.where(F.getbit("_mask", (spot % WORD).cast("int")) == 1).select(*rows.columns)
