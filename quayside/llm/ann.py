"""Nearest neighbours by a vantage-point tree per shard.

A node holds a vantage point and the median distance to it; nearer points go inside, the others outside. A query leaves
out a side whose lower bound by the triangle inequality, times ``relax``, is beyond its k-th nearest so far: with a
factor of one nothing can be missed, a larger one prunes more. Queries pass a tree together, as arrays.

Vectors are dealt to shards by hash; equal vectors of a shard share one point of its tree, which carries the smallest ids
(as many as a query can return), so a vector that a third of all rows repeat costs no more than any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.common import query, table

#: Vectors in a shard, queries in a block, points in a leaf.
SHARD, BLOCK, LEAF = 8192, 4096, 64


class Tree:
    """A vantage-point tree over distinct vectors, each with its smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keep: int) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order], dtype=np.float64)
        raw = (vectors + 0.0).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
        _, first, group = np.unique(raw, return_index=True, return_inverse=True)
        self.points = vectors[first]
        self.norms = (self.points**2).sum(1)
        by = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[by], np.arange(len(first) + 1))
        self.ids = [ids[by[a : min(b, a + keep)]] for a, b in zip(cuts, cuts[1:], strict=False)]
        self.root = self.grow(np.arange(len(first)))

    def distances(self, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Euclidean distances of queries and points, each summed from differences. Where squares would leave the range of
        a double, the differences are divided by the largest one first."""
        with np.errstate(over="ignore", under="ignore"):
            apart = queries[:, None, :] - self.points[at][None, :, :]
            out = np.sqrt((apart**2).sum(2))
            odd = np.nonzero((out < 1e-140) | (out > 1e140))
            if len(odd[0]):
                part = apart[odd]
                top = np.abs(part).max(1, initial=0.0)
                safe = np.where((top > 0) & np.isfinite(top), top, 1.0)[:, None]
                out[odd] = np.where(np.isfinite(top), top * np.sqrt(((part / safe) ** 2).sum(1)), np.inf)
        return out

    def grow(self, at: np.ndarray):
        """A leaf is an array; a node is (point, radius, inside, outside). The point lies far from the first one."""
        if len(at) <= LEAF:
            return at
        d = self.distances(self.points[at[:1]], at)[0]
        point = int(at[d.argmax()])
        rest = at[at != point]
        d = self.distances(self.points[[point]], rest)[0]
        inner = np.argsort(d, kind="stable")
        half = len(rest) // 2
        radius = (d[inner[half - 1]] + d[inner[half]]) / 2
        return point, float(radius), self.grow(rest[inner[:half]]), self.grow(rest[inner[half:]])

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (query number, id, distance): the ``k`` nearest of each query but its own row, ties to the smaller id."""
        self.k, self.relax, self.own, self.queries = k, relax, own, queries
        self.best = np.full((len(own), k), np.inf)
        self.names = np.full((len(own), k), np.iinfo(np.int64).max)
        if len(self.points):
            self.visit(self.root, np.arange(len(own)))
        found = self.names != np.iinfo(np.int64).max
        row, column = np.nonzero(found)
        return row, self.names[row, column], self.best[row, column]

    def offer(self, who: np.ndarray, at: np.ndarray, d: np.ndarray) -> None:
        """Take points (d: queries by points) into the running best."""
        names = [self.ids[i] for i in at]
        wide = np.repeat(np.arange(len(at)), [len(n) for n in names])
        flat = np.concatenate(names)
        far = d[:, wide]
        same = flat[None, :] == self.own[who][:, None]
        all_d = np.hstack([self.best[who], np.where(same, np.inf, far)])
        all_n = np.hstack([self.names[who], np.where(same, np.iinfo(np.int64).max, flat[None, :])])
        order = np.lexsort((all_n, all_d), axis=1)[:, : self.k]
        self.best[who] = np.take_along_axis(all_d, order, 1)
        self.names[who] = np.take_along_axis(all_n, order, 1)

    def visit(self, node, who: np.ndarray) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            for a in range(0, len(who), 256):
                part = who[a : a + 256]
                d = self.distances(self.queries[part], node)
                near = (d <= self.best[part, -1:]).any(1)
                if near.any():
                    self.offer(part[near], node, d[near])
            return
        point, radius, inside, outside = node
        at = np.array([point])
        d = self.distances(self.queries[who], at)
        self.offer(who, at, d)
        d = d[:, 0]
        inner = d <= radius
        self.visit(inside, who[inner])
        self.visit(outside, who[~inner])
        with np.errstate(over="ignore", invalid="ignore"):
            gap = np.abs(d - radius) * self.relax
            gap -= 1e-9 * np.maximum(1e-300, np.minimum(d, radius))  # rounding must not hide a tie
            open_ = ~(gap > self.best[who, -1])
        self.visit(outside, who[inner & open_])
        self.visit(inside, who[~inner & open_])


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part: key given, no component null, NaN or infinite, not zero."""
    v = F.col("vector")
    whole = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return whole.where(F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0))


def nearest(base: DataFrame, queries: DataFrame, k: int = 10, relax: float = 1.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of ``base`` for each row of ``queries``: ``query_id``, ``rank``, ``vec_id``, ``score`` (distance).

    A row with no usable vector takes no part on either side; a query's own id is no candidate; rows that repeat an id
    and vector count once per row of ``base``; of several query rows with one id the one with the least vector asks; a
    vector is only compared with those of as many components; with fewer than ``k`` candidates all are returned; empty
    tables give no rows. Finite vectors of any size take part; a distance beyond the range of a double is infinite. Other
    columns are not read.
    """
    vectors = usable(base, key, vector).withColumn("dim", F.size("vector"))
    asked = usable(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    shards = max(1, -(-base.count() // SHARD))
    blocks = max(1, -(-queries.count() // BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    right = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))

    def run(points: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree = Tree(points["id"].to_numpy(), np.stack(points["vector"].to_numpy()), k + 1)
        own = wanted["id"].to_numpy()
        row, names, far = tree.search(own, np.stack(wanted["vector"].to_numpy()).astype(np.float64), k, relax)
        return pd.DataFrame({"query_id": own[row], "vec_id": names, "score": far})

    keys = ["dim", "shard", "block"]
    per_shard = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = per_shard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


@query("op8_vantage_point_search")
def vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every hundredth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10, relax=1.2)
