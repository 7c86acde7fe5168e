"""Exact distinct counts that can be merged: bitmaps over densely numbered members.

A group's members become bitmaps of 32,768 numbers each. Two groups are united by or-ing their bitmaps, so counts of
coarser groups follow from those of finer ones without going back to the rows, and a hot group travels as bitmaps, not
as its members.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash ranges that members are numbered in: a range is sorted in one task, the counts of all ranges in another.
RANGES = 1024


def number_members(df: DataFrame, key: str, number: str = "_number", ranges: int = RANGES) -> DataFrame:
    """The distinct values of ``key`` (null left out) with numbers from 0 on, without gaps.

    Members are ranked within hash ranges; a running sum over the ranges' counts, one row a range, makes the ranks dense.
    Choose ``ranges`` so that the members of one fit into a task. The same members get the same numbers again.
    """
    members = df.select(key).where(F.col(key).isNotNull()).distinct()
    members = members.withColumn("_range", F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int"))
    counts = members.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return members.withColumn("_rank", rank).join(starts, "_range").select(key, (F.col("_start") + F.col("_rank")).alias(number))


def member_bitmaps(df: DataFrame, keys: Sequence[str], number: str = "_number", out: str = "_bits") -> DataFrame:
    """Per group and bucket of numbers (``_bucket``) the bitmap of the members seen; combines before its shuffle."""
    bucket = F.bitmap_bucket_number(number).alias("_bucket")
    return df.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(out))


def merge_bitmaps(df: DataFrame, keys: Sequence[str], bits: str = "_bits") -> DataFrame:
    """The same for coarser groups."""
    return df.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg(bits).alias(bits))


def counted(bits: str | Column = "_bits") -> Column:
    """Members of a group: the sum over its buckets."""
    return F.coalesce(F.sum(F.bitmap_count(F.col(bits) if isinstance(bits, str) else bits)), F.lit(0).cast("bigint"))


def rollup_bitmaps(df: DataFrame, levels: Sequence[str], also: Sequence[str] = (), bits: str = "_bits") -> DataFrame:
    """Bitmaps of every level and of the total: coarser groups have nulls in the finer levels, ``_level`` counts the others.

    The rows are read once, and what is copied per level are bitmaps.
    """
    depths = F.explode(F.sequence(F.lit(0), F.lit(len(levels)))).alias("_level")
    spread = df.select("*", depths)
    cut = [F.when(F.col("_level") > k, F.col(c)).alias(c) for k, c in enumerate(levels)]
    return merge_bitmaps(spread.select(*cut, "_level", *also, "_bucket", bits), [*levels, "_level", *also], bits)
