"""Exact distinct counts that merge: bitmaps of whole numbers by key.

A bitmap covers a bucket of 32,768 numbers; a date's numbers become a few bitmaps, which are
stored. The distinct count of any set of dates is the number of bits in the union of theirs,
so a new date is added without reading the others, and nothing is estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def number_bitmaps(df: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """(keys, ``name``, ``bucket``, ``bits``): the distinct values of each whole-number column by key.

    NULL is no value. Bits are set map-side, so what is shuffled are bitmaps (4 KB each) and
    not values; values far apart make more bitmaps than dense ones.
    """
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("value")) for c in columns]))
    values = df.select(*keys, named.alias("_n")).select(*keys, "_n.name", "_n.value").where("value IS NOT NULL")
    return (values.groupBy(*keys, "name", F.bitmap_bucket_number("value").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")))


def merge_bitmaps(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Union of bitmaps of finer keys: (keys, ``name``, ``bucket``, ``bits``)."""
    return bitmaps.groupBy(*keys, "name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """(keys, ``name``, ``distinct_values``) of bitmaps, merged first."""
    return merge_bitmaps(bitmaps, *keys).groupBy(*keys, "name").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))
