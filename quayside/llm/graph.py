"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import run_dir, stage


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node to the smallest of them: the larger ones, or the smaller ones and the node itself."""
    spark = pairs.sparkSession
    if large:
        seen = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        seen, least = stage(seen, run_dir(spark, "seen")), stage(least, run_dir(spark, "least"))
        return seen.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = stage(pairs.groupBy("a").agg(F.min("b").alias("m")), run_dir(spark, "least"))
    tied = pairs.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for each node of ``edges`` (a, b) but the smallest ones themselves.

    The smallest neighbours are written out before they are joined back, so that a node with very many edges can be split
    over tasks.
    """
    spark = edges.sparkSession
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stage(pairs, run_dir(spark, "edges"))
    mark = lambda p: p.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    before = mark(pairs)
    while True:
        pairs = stage(_star(stage(_star(pairs, True), run_dir(spark, "large")), False), run_dir(spark, "small"))
        after = mark(pairs)
        if after == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = after
