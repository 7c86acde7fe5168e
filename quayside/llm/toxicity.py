"""Toxicity by weak supervision.

Voters are lexicon entries: whole words and word beginnings that labelled rows mark as telling, found by a likelihood
ratio test on a bounded sample. Pattern voters look at how many words fire and how densely. A generative label model sees
nothing but their votes: from the majority on, it estimates by expectation maximisation how often each voter is right and
which voters agree beyond that; those share their evidence. A linear classifier is trained on the posterior labels. Labels
choose the voters and place the cut, a score of 0.7, and are read for nothing else. Every whole text is scored in one
narrow pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Memo, as_text, query, table, text_slices
from quayside.session import run_dir, stage

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that may become voters.
STEMS = (4, 5, 6, 7)


@dataclass(frozen=True)
class Model:
    """Voters by word and by beginning, and the weights of the linear classifier over their counts."""

    voters: dict[str, int]
    weights: np.ndarray
    bias: float

    def memo(self) -> Memo:
        return Memo(self.fired, 300_000)

    def fired(self, word: str) -> tuple[int, ...]:
        keys = ["=" + word, *("^" + word[:n] for n in STEMS if len(word) >= n)]
        return tuple(v for k in keys if (v := self.voters.get(k)) is not None)

    def counts(self, text: str, memo: Memo) -> tuple[Counter, int, int]:
        """How often each voter fires, in how many words any does, and the number of words."""
        words = WORD.findall(text.lower())
        hits = [f for f in map(memo.__getitem__, words) if f]
        return Counter(v for f in hits for v in f), len(hits), len(words)

    def score(self, text: str, memo: Memo) -> float:
        fired, hits, words = self.counts(text, memo)
        z = self.bias + float(shape(hits, words) @ self.weights[len(self.voters) :])
        return float(_sigmoid(z + sum(self.weights[v] * np.log1p(n) for v, n in fired.items())))


#: Features besides the voters' counts.
SHAPES = 4


def shape(hits: int, words: int) -> np.ndarray:
    return np.array([min(hits, 1), min(hits, 2) / 2, np.log1p(hits), np.log1p(100 * hits / max(words, 20))])


def patterns(hits: int, words: int) -> tuple[list[bool], list[bool]]:
    """Pattern voters: which vote toxic, and which vote clean."""
    dense = 100 * hits / max(words, 20)
    return [hits >= 2, hits >= 4, hits >= 8, dense >= 0.5, dense >= 1.5], [hits == 0, hits <= 1, dense < 0.15]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``doc_id``, ``text``, ``toxic`` of at most ``most`` labelled rows outside the held-out third, by hash of the id."""
    learn = labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    chosen = learn.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")


def find_voters(train: DataFrame, most: int = 400) -> dict[str, int]:
    """Words and beginnings that toxic rows have far more often than clean ones: the ``most`` strongest at most.

    The bar rises with the number of features tried, so that chance finds stay out.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)")))
    told = train.select("doc_id", "toxic", F.explode(words).alias("word"))
    keys = F.array(F.concat(F.lit("="), "word"), *[F.when(F.length("word") >= n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in STEMS])
    features = told.select("doc_id", "toxic", F.explode(keys).alias("key")).where("key is not null").distinct()
    counted = features.groupBy("key").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
    rows, positive = train.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not rows or not positive or positive == rows:
        return {}
    base, tried = positive / rows, max(2, counted.count())
    observed = F.col("pos") / F.col("n")
    inside = F.col("pos") * F.log(observed / base) + F.when(observed < 1, (F.col("n") - F.col("pos")) * F.log((1 - observed) / (1 - base))).otherwise(0.0)
    telling = counted.where((F.col("pos") >= 3) & (observed > 0.8)).withColumn("gain", 2 * inside)
    strong = telling.where(F.col("gain") > 2 * float(np.log(tried)) + 4).orderBy(F.desc("gain"), "key").limit(most)
    return {key: i for i, key in enumerate(drop_nested({r["key"]: r["n"] for r in strong.select("key", "n").collect()}))}


def drop_nested(rows: dict[str, int]) -> list[str]:
    """Without keys that a shorter beginning stands for: one in just as many rows."""
    kept: list[str] = []
    for key in sorted(rows, key=lambda k: (len(k), k[0] == "=", k)):
        if not any("^" + key[1:n] in rows and rows["^" + key[1:n]] == rows[key] for n in range(2, len(key) + (key[0] == "="))):
            kept.append(key)
    return kept


def label_model(toxic: np.ndarray, clean: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of toxic for each row, from the 0/1 votes for it (``toxic``) and against it (``clean``).

    A model of two classes: each voter votes with one probability in toxic rows and another in the others, the larger one
    on its own side; voters that vote alike on every row are one. The start is the share of a row's votes that say toxic.
    Every ten rounds the correlation of votes within the classes is estimated from what voters agree on, and a voter's
    evidence is divided by the sum of its squared correlations with all voters. Without rows or votes the posterior is 0.
    """
    n = len(toxic)
    toxic, clean = (np.unique(side[:, side.any(0)], axis=1) for side in (toxic, clean))
    votes, m = np.hstack([toxic, clean]), toxic.shape[1] + clean.shape[1]
    if not n or not m:
        return np.zeros(n)
    says = np.arange(m) < toxic.shape[1]
    post = np.clip(toxic.sum(1) / np.maximum(votes.sum(1), 1), 0.02, 0.98)
    share, mean = np.ones(m), votes.mean(0)
    for turn in range(rounds):
        prior = (post.sum() + 1) / (n + 2)
        one = np.clip((votes.T @ post + mean) / (post.sum() + 1), 1e-4, 1 - 1e-4)
        zero = np.clip((votes.T @ (1 - post) + mean) / ((1 - post).sum() + 1), 1e-4, 1 - 1e-4)
        one, zero = np.where(says, np.maximum(one, zero), np.minimum(one, zero)), np.where(says, np.minimum(one, zero), np.maximum(one, zero))
        if turn % 10 == 4:
            rest = votes - (post[:, None] * one + (1 - post)[:, None] * zero)
            spread = np.sqrt((rest**2).mean(0)) + 1e-9
            share = 1 / np.maximum(1, ((rest.T @ rest / n / np.outer(spread, spread)) ** 2).sum(1))
        given, kept = share * np.log(one / zero), share * np.log((1 - one) / (1 - zero))
        post = _sigmoid(np.log(prior / (1 - prior)) + votes @ (given - kept) + kept.sum())
    return post


def fit_linear(x: np.ndarray, soft: np.ndarray, ridge: float = 0.3, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, hold = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    hold[-1] = 1e-3
    for _ in range(rounds):
        p = _sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(hold + 1e-9), a.T @ (p - soft) + hold * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train_model(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> Model:
    """Fit on at most ``most`` labelled rows, which are written to the shared folder once. Null labels, null ids and null
    texts teach nothing; of an id with several labels the highest counts. With no labels of both kinds every text scores
    near the prior."""
    chosen = stage(sample(docs, labels, most), run_dir(docs.sparkSession, "labelled"))
    voters = find_voters(chosen)
    empty = Model(voters, np.zeros(len(voters) + SHAPES), 0.0)

    def run(batches):
        memo = empty.memo()
        for part in text_slices(batches):
            rows = [empty.counts(t, memo) for t in as_text(part.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "toxic": part.column("toxic").cast(pa.int32()),
                "voters": pa.array([list(r[0]) for r in rows], pa.list_(pa.int32())),
                "fired": pa.array([list(r[0].values()) for r in rows], pa.list_(pa.int32())),
                "hits": pa.array([r[1] for r in rows], pa.int32()),
                "words": pa.array([r[2] for r in rows], pa.int32()),
            })

    schema = "toxic int, voters array<int>, fired array<int>, hits int, words int"
    told = chosen.sortWithinPartitions("doc_id").select("text", "toxic").mapInArrow(run, schema).collect()
    if not voters or not told:
        rate = (sum(r["toxic"] for r in told) + 0.5) / (len(told) + 1)
        return Model(voters, empty.weights, float(np.log(rate / (1 - rate))) if told else -2.0)
    x, lexicon = np.zeros((len(told), len(voters) + SHAPES)), np.zeros((len(told), len(voters)))
    for i, r in enumerate(told):
        x[i, r["voters"]] = np.log1p(r["fired"])
        lexicon[i, r["voters"]] = 1
        x[i, len(voters) :] = shape(r["hits"], r["words"])
    gold = np.array([r["toxic"] for r in told], float)
    said = [patterns(r["hits"], r["words"]) for r in told]
    toxic = np.hstack([lexicon, np.array([a for a, _ in said], float)])
    weights, bias = fit_linear(x, label_model(toxic, np.array([b for _, b in said], float)))
    scale, shift = calibrate(x @ weights + bias, gold)
    return Model(voters, weights * scale, bias * scale + shift)


def calibrate(z: np.ndarray, gold: np.ndarray) -> tuple[float, float]:
    """Scale and shift that put the cut with the fewest mistakes on the learning rows at a score of 0.7."""
    order = np.argsort(z)
    sorted_z, toxic = z[order], gold[order]
    wrong = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum((1 - toxic)[::-1])[::-1], [0]])
    ends = np.concatenate([[sorted_z[0] - 2], sorted_z, [sorted_z[-1] + 2]])
    gaps = np.diff(ends)
    best = min(np.flatnonzero(wrong == wrong[gaps > 1e-9].min()), key=lambda i: -gaps[i])
    cut = (ends[best] + ends[best + 1]) / 2
    scale = max(1.0, 4 / max(gaps[best], 0.5))
    return scale, float(np.log(0.7 / 0.3)) - cut * scale


def scorer(model: Model) -> Callable[[Column], Column]:
    """The score of a text column. Only texts go to Python and only numbers come back; the rest of a row stays behind."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = model.memo()
        for texts in batches:
            yield pd.Series([model.score(t or "", memo) for t in texts], dtype=np.float64)

    return F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)


def score_texts(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """``columns`` of ``docs`` and ``out``, the score of every whole text. Null and empty texts score as a text in which no
    voter fires; repeated rows score alike; an empty table gives no rows; other columns are not read. ``out`` must not be
    among ``columns``."""
    if out in columns:
        raise ValueError(f"{out} is a column already")
    return docs.select(*(F.col(f"`{c}`") for c in columns), scorer(model)(F.col("text")).alias(out))


@query("op7_weak_toxicity")
def weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; two thirds of the labels are learned from, one third is held out."""
    docs = table(spark, sf_dir, "documents")
    model = train_model(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model).select(
        "doc_id",
        (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
