"""Exact distinct counts that can be stored and merged: bitmaps of whole-number ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Per group of ``keys`` and block of 32768 ids the set of ids in ``value`` as a bitmap of 4 KB.

    Ids without gaps fill the blocks; a group of few, widely spread ids takes a block for each. Null ids are in no set.
    """
    ids = df.filter(F.col(value).isNotNull())
    return ids.groupBy(*keys, F.bitmap_bucket_number(value).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("ids")
    )


def merged(sets: DataFrame, *keys: str) -> DataFrame:
    """The sets of coarser groups: no id is looked at again."""
    return sets.groupBy(*keys, "block").agg(F.bitmap_or_agg("ids").alias("ids"))


def counted(sets: DataFrame, name: str, *keys: str) -> DataFrame:
    """The number of distinct ids per group of ``keys``."""
    return merged(sets, *keys).groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(name))
