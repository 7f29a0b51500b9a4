"""A test for keys that stands before costly work: a bit array of their hashes.

For rows too wide to shuffle and too costly to read in vain, such as pages: the array
is built once from the wanted keys and probed where the rows are scanned. A row that is
not wanted passes with a small probability, a wanted one always, so an exact join
follows. The array goes by the number of different keys, up to 16 MB: with more keys than
that is made for it lets more rows pass, and never drops one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 64-bit words of the array, at least and at most: 1 and 16 MB. A word for every eight
# keys lets two or three in a hundred pass by chance.
WORDS, MOST_WORDS, KEYS_PER_WORD = 1 << 17, 1 << 21, 8
BITS = 4


def place(key: Column, words: int) -> tuple[Column, Column]:
    """The key's word and the bits that it sets there."""
    word = F.pmod(F.xxhash64(F.lit("word"), key), F.lit(words)).cast("int")
    picks = F.xxhash64(F.lit("bits"), key)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(picks, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return word, mask


def words_for(keys: DataFrame, key: str) -> int:
    """A power of two, in proportion to the number of different keys within the bounds."""
    found = keys.agg(F.approx_count_distinct(key)).first()[0]
    return min(MOST_WORDS, max(WORDS, 1 << (found // KEYS_PER_WORD).bit_length()))


def bit_array(keys: DataFrame, key: str, words: int = WORDS) -> Column:
    """The array as a scalar subquery; ``keys`` should be a written table, as it is read for each use."""
    word, mask = place(F.col(key), words)
    filled = (
        keys.where(F.col(key).isNotNull())
        .select(word.alias("_word"), mask.alias("_mask"))
        .groupBy("_word")
        .agg(F.bit_or("_mask").alias("_bits"))
    )
    every = keys.sparkSession.range(0, words, 1, 1).select(F.col("id").cast("int").alias("_word"))
    dense = every.join(filled, "_word", "left").select("_word", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))
    in_order = F.sort_array(F.collect_list(F.struct("_word", "_bits")))
    return dense.agg(F.transform(in_order, lambda w: w["_bits"]).alias("_array")).scalar()


def may_be_among(rows: DataFrame, column: str, keys: DataFrame, key: str, words: int | None = None) -> DataFrame:
    """The rows whose column is among the keys, and few others; rows without one are dropped.

    Without ``words`` the keys are counted first.
    """
    if words is None:
        words = words_for(keys, key)
    word, mask = place(F.col(column), words)
    held = F.get(bit_array(keys, key, words), word)
    return rows.where(F.col(column).isNotNull() & (held.bitwiseAND(mask) == mask))
