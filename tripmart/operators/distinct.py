"""Exact distinct counts from bitmaps.

A member with a dense id is one bit.  The ids go into buckets of 32,768, a
bitmap of 4 KB each, so a group of any size is many rows and never one
value.  Bitmaps of days are merged by OR: a distinct count over any span of
days reads the days' bitmaps only, never the trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_bitmaps(members: DataFrame, ids: DataFrame, keys, member: str, id_col: str) -> DataFrame:
    """``keys``, ``bucket``, ``bits``: which ids of ``ids(id_col, member)`` occur under each key.

    ``members`` should hold each (keys, member) once: the join then carries
    distinct pairs, and a member of a third of all rows is a few of them.
    Ids count from 1.  Members that are null or have no id have no bit.
    """
    known = members.join(ids.select(id_col, member), member)
    return known.groupBy(*keys, F.bitmap_bucket_number(F.col(id_col)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_col))).alias("bits"))


def distinct_from_bitmaps(bitmaps: DataFrame, keys, out_col: str) -> DataFrame:
    """``keys`` and the exact number of different ids in their bitmaps.

    Merged per (keys, bucket) first, combined in the map tasks, so a key of
    many buckets is spread over tasks; what is summed per key are counts.
    """
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*keys).agg(F.sum("n").alias(out_col))
