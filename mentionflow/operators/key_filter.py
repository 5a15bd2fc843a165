"""Bit sets of keys, tested where rows are made, so that only rows with a partner are shuffled.

A set of keys becomes bitmaps: each key sets HASHES bits among KEY_BITS for each key. A row
whose bits are not all set has no partner for certain; about one in 200 others passes and
meets the join that follows, so results are exact whatever the size of the set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

#: Bytes of keys that are broadcast at most; beyond that their bit set is tested and the join shuffles.
BROADCAST_BYTES = 8 << 20
#: Bits for each key, and bits that a key sets.
KEY_BITS, HASHES = 16, 3
#: Bits of a bitmap as Spark's functions build them.
BITMAP_BITS = 8 * 4096
#: Bits of a set at most (8 MB). A larger set of keys fills it more, and more rows pass.
MOST_BITS = 1 << 26

_WORD_BITS = 32


class KeyFilter:
    """Tells which values may be among the keys of a frame.

    The bitmaps are aggregated in Spark and reach the scan as a scalar subquery, so their
    size is bounded by MOST_BITS and no row of the keys passes the driver. NULL is no key.
    """

    def __init__(self, keys: DataFrame, column: str):
        count = keys.count()
        self.bitmaps = max(1, min(-(-count * KEY_BITS // BITMAP_BITS), MOST_BITS // BITMAP_BITS))
        places = (keys.where(F.col(column).isNotNull())
                  .select(F.explode(F.array(*[self._place(F.col(column), k) for k in range(HASHES)])).alias("place")))
        built = (places.groupBy(F.bitmap_bucket_number("place").alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
        every = keys.sparkSession.range(1, self.bitmaps + 1).withColumnRenamed("id", "number")
        empty = F.unhex(F.lit("00" * (BITMAP_BITS // 8)))
        filled = every.join(built, F.col("number") == F.col("bucket"), "left").select("number", F.coalesce("bits", empty).alias("bits"))
        words = F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // _WORD_BITS - 1)), lambda k: (k * (_WORD_BITS // 8) + 1).cast("int"))
        numbers = filled.select("number", F.transform(words, lambda at: F.conv(F.hex(F.substring(F.col("bits"), at, F.lit(_WORD_BITS // 8))), 16, 10).cast("long")).alias("words"))
        self.words = materialize(numbers.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("number", "words"))), lambda b: b["words"])).alias("words")), "key-filter")

    def _place(self, value: Column, k: int) -> Column:
        return F.pmod(F.xxhash64(value, F.lit(k)), F.lit(self.bitmaps * BITMAP_BITS)) + 1

    def may_hold(self, value: Column) -> Column:
        """True for every value among the keys, and for few others."""
        words = self.words.scalar()

        def is_set(k: int) -> Column:
            bit = self._place(value, k) - 1
            # a word has its first byte in front, and a byte its first bit at the end
            inside = F.lit(_WORD_BITS // 8 - 1) - F.floor(F.pmod(bit, F.lit(_WORD_BITS)) / 8)
            shift = (inside * 8 + F.pmod(bit, F.lit(8))).cast("int")
            word = F.get(words, F.shiftright(bit, 5).cast("int"))
            return F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1)) == 1

        test = is_set(0)
        for k in range(1, HASHES):
            test = test & is_set(k)
        return test


def join_keys(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` with the columns of ``keys`` of equal ``column``; made for many rows without a partner.

    ``keys`` is stored and has one row per key. A small side is broadcast after its bytes are
    summed; otherwise rows without a partner are dropped before the shuffle.
    """
    size = keys.agg(F.count("*").alias("n"), F.sum(F.octet_length(column)).alias("bytes")).first()
    if (size.bytes or 0) + 32 * size.n <= BROADCAST_BYTES:
        return rows.join(F.broadcast(keys), column)
    return rows.where(KeyFilter(keys, column).may_hold(F.col(column))).join(keys, column)
