"""Hard negatives by lists that a cluster of anchors shares.

Anchors are clustered by direction. For a cluster with centre c and widest angle w no row x scores more with a member a
than |a| |x| cos(max(0, angle(c, x) - w)). The rows are sorted once by the part of this bound that belongs to x; every
member walks that list from the top and stops as soon as the bound of the rest can no longer reach what it looks for.

Both steps are such walks: the positives are the best rows of the anchor's label; the negatives are, for each positive,
the best rows of other labels within a window of scores that the positive's score sets. Anchors are dealt to blocks of
whole clusters and rows to shards. Shards are worked off in rounds of growing size, and each round starts from the rows
found before, so a walk ends early and a round returns only rows that are better.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.common import query, table
from quayside.session import run_dir, stage

#: Rows in a shard, anchors in a block, rows looked at together.
SHARD, BLOCK, STEP = 32768, 8192, 2048
#: Anchors that place the centres, and most centres; both bound what the driver sees.
SAMPLE, CENTRES = 4096, 64
#: Each round reads so many times as many shards as all rounds before.
GROWTH = 8
#: Integers up to this are exact as doubles.
EXACT = float(2**53)
LONG = 2**63 - 1


def quantise(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * component); doubles where scores stay exact as doubles, else Python integers. ``scale`` is a power of 2."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * scale)
    most = np.abs(scaled).max(initial=0.0)
    if most * most * max(1, vectors.shape[1]) < EXACT:
        return scaled
    whole = [[int(x) * scale if abs(x) >= EXACT else math.floor(x * scale) for x in row] for row in vectors.tolist()]
    return np.array(whole, dtype=object).reshape(vectors.shape)


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector has no direction and length 0. Scaled first, so huge components do no harm."""
    top = np.abs(vectors).max(axis=1, initial=0.0, keepdims=True)
    small = vectors / np.where(top > 0, top, 1.0)
    length = np.sqrt((small**2).sum(1, keepdims=True))
    with np.errstate(over="ignore"):
        return small / np.where(length > 0, length, 1.0), (length * top)[:, 0]


def find_centres(directions: np.ndarray, most: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; the same rows in the same order give the same centres."""
    k = max(1, min(most, math.isqrt(len(directions))))
    centres = directions[np.linspace(0, len(directions) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = (directions @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, directions)
        length = np.sqrt((sums**2).sum(1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.where(length > 1e-9, length, 1.0), centres)
    return centres


class Walk:
    """The shared lists of one shard for the anchors of one block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, scale: int) -> None:
        self.ids, self.labels, self.vectors = ids, labels, quantise(vectors, scale)
        self.scale = scale
        self.directions, self.lengths = unit(self.vectors.astype(np.float64))
        self.looked = 0

    def bounds(self, members: np.ndarray) -> np.ndarray:
        """For each row the most it can score with a member of length one."""
        centre = members.sum(0)
        size = np.sqrt((centre**2).sum())
        centre = centre / size if size > 1e-9 else members[0]
        wide = np.arccos(np.clip(members @ centre, -1, 1)).max(initial=0.0)
        angle = np.arccos(np.clip(self.directions @ centre, -1, 1))
        return self.lengths * np.cos(np.clip(angle - wide - 1e-6, 0, np.pi))

    def search(self, own, labels, vectors, cluster, low, high, k: int, same: bool) -> list[tuple]:
        """Rows (anchor number, window, id, score) that belong to the best ``k`` of a window.

        ``low`` and ``high`` (anchors by windows) are whole scores, ends included; low > high makes an empty window. Higher
        scores come first, ties by smaller id.
        """
        asked = quantise(vectors, self.scale)
        exact = asked.dtype != object and self.vectors.dtype != object and self._fits(asked)
        rows, asked_rows = (self.vectors, asked) if exact else (_whole(self.vectors), _whole(asked))
        low, high = (x.astype(np.float64).clip(-EXACT, EXACT) if exact else x for x in (low, high))
        directions, lengths = unit(asked.astype(np.float64))
        out: list[tuple] = []
        for c in np.unique(cluster):
            members = np.flatnonzero(cluster == c)
            bound = self.bounds(directions[members])
            order = np.argsort(-bound, kind="stable")
            for label in np.unique(labels[members]):
                mine = members[labels[members] == label]
                fit = order[(self.labels[order] == label) == same]
                out += self._walk(fit, bound, mine, own, rows, asked_rows, lengths, low, high, k)
        return out

    def _fits(self, asked: np.ndarray) -> bool:
        return np.abs(asked).max(initial=0.0) * np.abs(self.vectors).max(initial=0.0) * max(1, asked.shape[1]) < EXACT

    def _walk(self, fit, bound, mine, own, rows, asked, lengths, low, high, k) -> list[tuple]:
        windows = low.shape[1]
        place = np.zeros(0, np.int64)  # number of member * windows + window, for each row found
        names, scores = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
        least, top = low[mine], high[mine]
        closed = least > top
        active = np.flatnonzero(~closed.all(1))
        for a in range(0, len(fit), STEP):
            reach = lengths[mine[active]] * bound[fit[a]]
            reach = reach * (1 + 1e-9 * np.sign(reach)) + 1e-6  # rounding must not end a walk
            wanted = np.where(closed[active], np.inf, least[active].astype(np.float64)).min(1)
            active = active[wanted <= reach]
            if not len(active):
                break
            at = fit[a : a + STEP]
            self.looked += len(active) * len(at)
            found = asked[mine[active]] @ rows[at].T
            if found.dtype == object:
                found = np.minimum(np.maximum(found, -LONG - 1), LONG)
            other = self.ids[at][None, :] != own[mine[active]][:, None]
            for w in range(windows):
                hit = other & (found >= least[active, w][:, None]) & (found <= top[active, w][:, None])
                hit &= ~closed[active, w][:, None]
                r, col = np.nonzero(hit)
                place = np.concatenate([place, active[r] * windows + w])
                names = np.concatenate([names, self.ids[at[col]]])
                scores = np.concatenate([scores, found[r, col]])
            by = _by_best(place, scores, names)
            place, names, scores = place[by], names[by], scores[by]
            rank = np.arange(len(place)) - np.searchsorted(place, place)
            place, names, scores, rank = (x[rank < k] for x in (place, names, scores, rank))
            full = rank == k - 1
            least[place[full] // windows, place[full] % windows] = scores[full]
        numbers = mine[place // windows]
        return list(zip(numbers.tolist(), (place % windows).tolist(), names.tolist(), [int(s) for s in scores], strict=True))


def _whole(vectors: np.ndarray) -> np.ndarray:
    """As Python integers."""
    return vectors if vectors.dtype == object else np.array([[int(x) for x in row] for row in vectors.tolist()], dtype=object).reshape(vectors.shape)


def _by_best(place: np.ndarray, scores: np.ndarray, names: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(place)), key=lambda i: (place[i], -scores[i], names[i])), dtype=np.int64)
    return np.lexsort((names, -scores, place))


def usable(df: DataFrame, key: str, vector: str, label) -> DataFrame:
    """``id``, ``label``, ``vector`` (doubles) and ``dim`` of rows with a key, a label and a vector without null, NaN or infinity."""
    v = F.col("vector")
    whole = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = whole.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return whole.withColumn("dim", F.size("vector"))


def deal_blocks(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``cluster`` and ``block``: neighbouring centres share a block; a cluster too large for one is split.

    Centres come from at most ``SAMPLE`` anchors of each length of vector by hash of the id, ``CENTRES`` at most; the counts
    of clusters are all that passes the driver besides. An anchor of a rarer length goes by its hash alone.
    """
    dims = anchors.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    main = dims[0]["dim"] if dims else 0
    sample = anchors.where(F.col("dim") == main).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()
    if not len(sample) or not main:
        centres = np.zeros((1, max(1, main)))
    else:
        centres = find_centres(unit(np.stack(sample["vector"].to_numpy()).astype(np.float64))[0], CENTRES)

    def nearest(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int32)
        fits = np.array([len(v) == centres.shape[1] for v in vectors], bool)
        if fits.any():
            out[fits] = (unit(np.stack(vectors[fits].to_numpy()).astype(np.float64))[0] @ centres.T).argmax(1)
        return pd.Series(out)

    dealt = anchors.withColumn("cluster", F.pandas_udf(nearest, "int")("vector"))
    dealt = stage(dealt, run_dir(anchors.sparkSession, "anchors"))
    order = np.argsort((centres @ centres[0]), kind="stable")  # neighbouring centres stay together
    counts = {r["cluster"]: r["count"] for r in dealt.groupBy("cluster").count().collect()}
    block, room, first, parts = 0, BLOCK, {}, {}
    for c in order.tolist():
        n = counts.get(c, 0)
        if n > room and room < BLOCK:
            block, room = block + 1, BLOCK
        first[c], parts[c] = block, max(1, -(-n // BLOCK))
        block, room = (block + parts[c], BLOCK) if n >= room else (block, room - n)
    pick = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])[F.col("cluster")]
    return dealt.withColumn("block", (pick(first) + F.pmod(F.xxhash64("id"), pick(parts).cast("long"))).cast("int"))


def best_in_windows(asks: DataFrame, rows: DataFrame, k: int, same: bool, scale: int, share: tuple[int, int] | None = None) -> DataFrame:
    """``id``, ``window``, ``other``, ``score``, ``rank``: the best ``k`` rows of each window of each ask.

    ``asks`` has the columns of ``deal_blocks`` and ``goals``, one score a window: a row is in it if 100 times its score
    lies between the two ``share`` of the goal; without ``share`` every score is. ``same`` keeps rows of the ask's label,
    else those of other labels. Only rows of the ask's length of vector count.
    """
    spark = asks.sparkSession
    blocks = [r["block"] for r in asks.select("block").distinct().orderBy("block").collect()]
    shards = max(1, -(-rows.count() // SHARD))
    left = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int"))
    left = left.withColumn("block", F.explode(F.array([F.lit(b) for b in blocks] or [F.lit(0)])))
    wanted = asks.withColumn("kept", F.transform("goals", lambda _: F.lit(None).cast("long")))

    def run(points: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(points) and len(some):
            walk = Walk(points["id"].to_numpy(), points["label"].to_numpy(), _matrix(points["vector"]), scale)
            own, low, high = some["id"].to_numpy(), [], []
            for goals, kept in zip(some["goals"], some["kept"], strict=True):
                ends = [(-LONG - 1, LONG) if share is None else (-(-share[0] * int(g) // 100), share[1] * int(g) // 100) for g in goals]
                low.append([a if math.isnan(s) else max(a, int(s)) for (a, _), s in zip(ends, kept, strict=True)])
                high.append([b for _, b in ends])
            most = max(map(len, low))  # an ask with fewer goals gets empty windows besides
            low, high = (np.array([[*x, *[fill] * (most - len(x))] for x in ends], dtype=object) for ends, fill in ((low, 1), (high, 0)))
            hits = walk.search(own, some["label"].to_numpy(), _matrix(some["vector"]), some["cluster"].to_numpy(), low, high, k, same)
            out = [(int(own[i]), w, other, score) for i, w, other, score in hits]
        return pd.DataFrame(out, columns=["id", "window", "other", "score"])

    keys, order = ["dim", "shard", "block"], Window.partitionBy("id", "window").orderBy(F.desc("score"), "other")
    found, start, stop = None, 0, 1
    while start < shards:
        now = left.where(F.col("shard").between(start, stop - 1))
        right = wanted.withColumn("shard", F.explode(F.sequence(F.lit(start), F.lit(min(stop, shards) - 1))))
        hits = now.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "id long, window int, other long, score long")
        if found is not None:
            hits = hits.unionByName(found.drop("rank"))
        found = stage(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), run_dir(spark, "best"))
        full = found.where(F.col("rank") == k).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("full"))
        wanted = asks.join(full, "id", "left").withColumn("kept", F.transform("goals", lambda _, i: F.col("full")[i])).drop("full")
        start, stop = stop, stop * GROWTH
    return found


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64).reshape(len(vectors), -1)


def mine(
    df: DataFrame,
    anchors: DataFrame,
    label,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``anchors`` in ``df``.

    Scores are inner products of floor(scale * component). An anchor's positives are its best rows of the same label; each
    brings the best rows of other labels with low * positive <= 100 * negative <= high * positive. Ties go to the smaller id.

    Rows with a null key, label or vector, or a null, NaN or infinite component take no part; a zero or empty vector
    scores 0 with every other. Vectors of another length than the anchor's are not compared with it. A row with the
    anchor's own id is never its positive or negative; otherwise each row of ``df`` counts, also one that repeats another.
    If several rows of ``anchors`` share an id, the one with the least label and vector asks. Empty tables and anchors
    without positives give no rows. Scores are exact; one beyond the range of a long counts as the end of that range. Other
    columns are not read. ``label`` is a column of both frames.
    """
    rows = usable(df, key, vector, label)
    asks = usable(anchors, key, vector, label).groupBy("id").agg(F.min(F.struct("label", "vector", "dim")).alias("s")).select("id", "s.*")
    asks = deal_blocks(asks)
    near = best_in_windows(asks.withColumn("goals", F.array(F.lit(0).cast("long"))), rows, positives, True, scale)
    goals = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("p"))
    goals = stage(goals.withColumn("goals", F.col("p.score")), run_dir(df.sparkSession, "goals"))
    far = best_in_windows(asks.join(goals.drop("p"), "id"), rows, negatives, False, scale, (low, high))
    return far.join(goals.select("id", "p"), "id").withColumn("p", F.col("p")[F.col("window")]).select(
        F.col("id").alias("anchor_id"),
        F.col("p.other").alias("positive_id"),
        "rank",
        F.col("other").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def noisy_label():
    """The label, one further where the id is divisible by 7."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@query("op12_hard_negatives")
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return mine(vectors, vectors.where("vec_id % 100 = 0"), noisy_label())
