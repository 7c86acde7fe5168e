"""Odd vectors of the nearest-neighbour search, the label model without labels, and odd tables through every pipeline stage."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import ann, lines, toxicity
from quayside.llm.common import ship

VECTORS = "vec_id long, embedding array<double>, shard int, score double"


def nearest(rows, k, own, query):
    good = [(i, v) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    found = sorted((math.dist(query, v), i) for i, v in good if i != own and len(v) == len(query))
    return [(own, r, i, d) for r, (d, i) in enumerate(found[:k], 1)]


def test_vectors_of_any_size_and_length(spark):
    ship(spark)
    rows = [(0, [1e200, 2.0], 1, 1.0), (1, [1.0, 2.0], 1, 1.0), (2, [3.0, -1e200], 1, 1.0), (3, [1.0, 2.0, 3.0], 1, 1.0), (4, [2e-200, 0.0], 1, 1.0), (5, [5e-201, 0.0], 1, 1.0)]
    rows += [(6, [1e-200, 0.0], 1, 1.0), (7, [2.0, 2.0, 3.0], 1, 1.0), (8, [float("nan"), 1.0], 1, 1.0), (9, [], 1, 1.0), (10, [0.0, 0.0], 1, 1.0), (11, [1.7e308, 1.7e308], 1, 1.0)]
    rows += [(12, [-1.7e308, -1.7e308], 1, 1.0), (6, [1e-200, 0.0], 1, 1.0), (None, [1.0, 1.0], 1, 1.0)]
    df = spark.createDataFrame(rows, VECTORS)
    for own in (0, 1, 3, 4, 5, 11):
        query = next(v for i, v, *_ in rows if i == own)
        got = [tuple(r) for r in ann.nearest(df, df.where(F.col("vec_id") == own), k=20, relax=1.0).orderBy("rank").collect()]
        want = nearest(rows, 20, own, query)
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert all(math.isclose(g[3], w[3], rel_tol=1e-12) for g, w in zip(got, want, strict=True))
    twice = spark.createDataFrame([(1, [5.0, 5.0], 1, 1.0), (1, [4.0, 4.0], 1, 1.0)], VECTORS)
    # the lesser of the two asks, and of the rows all but at zero the smallest id comes first
    assert [(r.vec_id, round(r.score, 9)) for r in ann.nearest(df, twice, k=1, relax=1.0).collect()] == [(4, round(math.dist([4, 4], [0, 0]), 9))]
    assert ann.nearest(df.limit(0), df, k=3).collect() == [] == ann.nearest(df, df.limit(0), k=3).collect()


def test_recall_as_registered(spark):
    """The registered query against brute force over all vectors: at least nine in ten of the nearest are found."""
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found = defaultdict(set)
    for r in ann.vantage_point_search(spark, sf).collect():
        found[r.query_id].add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((points - points[q]) ** 2).sum(1))
        best = [int(ids[i]) for i in np.lexsort((ids, d)) if i != q][:10]
        hits, total = hits + len(found[int(ids[q])] & set(best)), total + len(best)
    assert total and hits / total >= 0.9


def test_label_model_reads_votes_only():
    """Voters of known quality, some copied: the posterior finds the classes without a label, and copies change nothing."""
    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.2
    toxic = np.stack([np.where(truth, rng.random(3000) < hit, rng.random(3000) < miss) for hit, miss in ((0.8, 0.02), (0.7, 0.05), (0.6, 0.03), (0.5, 0.4))], 1).astype(float)
    clean = np.stack([np.where(truth, rng.random(3000) < 0.1, rng.random(3000) < 0.8) for _ in range(2)], 1).astype(float)
    post = toxicity.label_model(toxic, clean)
    assert ((post > 0.5) == truth).mean() > 0.95
    again = toxicity.label_model(np.hstack([toxic, toxic[:, :1], toxic[:, :1]]), np.hstack([clean, clean[:, 1:]]))
    assert np.allclose(post, again, atol=1e-12)
    assert toxicity.label_model(np.zeros((3, 2)), np.zeros((3, 1))).tolist() == [0, 0, 0] and len(toxicity.label_model(np.zeros((0, 2)), np.zeros((0, 1)))) == 0


@pytest.fixture(scope="module")
def odd_documents(spark):
    names = "score _position _turn _stays _positions _key _none copies component_id size target".split()
    long = "one two three four five six seven " * 2000
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "some words of text here now", "en", "a", 9), (3, long, "en", "b", 5), (4, "a line of text\nanother line", "en", "b", 5)]
    rows += [(4, "a line of text\nanother line", "en", "b", 5), (5, long + "eight", "en", "b", 5), (6, "x", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables_and_any_column(spark, odd_documents, name):
    ship(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd_documents, "/root/testdata/sf0.001")
    if name != "bpe":
        assert out.columns == odd_documents.columns
        assert all(r["score"] == "own score" and r["_position"] == "own _position" and r["_stays"] == "own _stays" for r in out.collect())
    counts = {"toxicity": 8, "line_dedup": 8, "near_duplicates": 7, "bpe": 8}
    assert out.count() == counts.get(name, out.count())
    empty = stage(spark, odd_documents.limit(0), "/root/testdata/sf0.001")
    assert empty.collect() == []


def test_edit_bounds_that_are_not_built_fail(spark):
    docs = spark.createDataFrame([(1, "a line of some length")], "doc_id long, text string")
    for edits in (2, -1):
        with pytest.raises(ValueError):
            lines.dedup_lines(docs, edits=edits)
    assert lines.dedup_lines(docs, edits=0).first().text == "a line of some length"
