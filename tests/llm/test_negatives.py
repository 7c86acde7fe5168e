"""Hard negatives against brute force, with odd rows, ties, huge values and several shards, blocks and rounds."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import negatives
from quayside.llm.common import ship

LONG = 2**63 - 1
SCHEMA = "vec_id long, embedding array<double>, label int, score string, id int"


def brute(rows, every=100, positives=5, keep=10):
    """All results of the contract by plain loops over Python integers."""
    good = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        good.append((vec_id, label, [math.floor(x * 256) if abs(x) < 2.0**53 else int(x) * 256 for x in vector], vector))
    asks = {}
    for row in good:
        if row[0] % every == 0 and (row[0] not in asks or (row[1], row[3]) < (asks[row[0]][1], asks[row[0]][3])):
            asks[row[0]] = row
    out = set()
    for a in asks.values():
        scored = [(-max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(a[2], b[2])))), b[0], b[1]) for b in good if b[0] != a[0] and len(b[2]) == len(a[2])]
        scored.sort()
        for p, pid, _ in [s for s in scored if s[2] == a[1]][:positives]:
            hard = [s for s in scored if s[2] != a[1] and 30 * -p <= 100 * -s[0] <= 90 * -p][:keep]
            out |= {(a[0], pid, r, n, -p, -s) for r, (s, n, _) in enumerate(hard, 1)}
    return out


def result(df, every=100):
    got = [tuple(r) for r in negatives.mine(df, df.where(F.col("vec_id") % every == 0), negatives.noisy_label()).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("tiny", [False, True])
def test_brute_force(spark, monkeypatch, tiny):
    ship(spark)
    if tiny:
        for name, value in {"SHARD": 80, "BLOCK": 20, "STEP": 16, "GROWTH": 2, "SAMPLE": 30}.items():
            monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 6))
    base[200:300] = base[7]  # a group of copies
    rows = [(i, base[i].tolist(), int(rng.integers(0, 4)), "x", 1) for i in range(400)]
    assert result(spark.createDataFrame(rows, SCHEMA), 20) == brute(rows, 20)


def test_odd_rows(spark):
    ship(spark)
    rows = [(0, [1.0, 2.0], 1, None, 1), (0, [0.5, 2.0], 1, None, 1), (1, None, 1, None, 1), (2, [1.0, None], 1, "s", 1), (3, [float("nan"), 1.0], 1, "s", 1)]
    rows += [(4, [float("inf"), 1.0], 1, "s", 1), (5, [0.0, 0.0], 1, "s", 1), (6, [1.0, 1.0, 1.0], 1, "s", 1), (8, [], 1, "s", 1), (9, [0.9, 2.1], None, "s", 1)]
    rows += [(None, [1.0, 2.0], 1, "s", 1), (10, [1.0, 2.0], 1, "s", 1), (11, [0.5, 1.0], 2, "s", 1), (11, [0.5, 1.0], 2, "s", 1), (12, [0.4, 1.1], 3, "s", 1)]
    rows += [(100, [1e200, 3.0], 4, "s", 1), (101, [1e150, 3.0], 4, "s", 1), (102, [7e150, -3.0], 5, "s", 1), (200, [-1.0, -1.0], 6, "s", 1), (300, [2.0**40, 2.0**30], 4, "s", 1)]
    rows += [(13, [0.1, 0.5], 3, "s", 1), (14, [0.3, 0.2], 5, "s", 1), (201, [1.0, 1.0], 6, "s", 1), (400, [3.0, 1.0, 2.0], 1, "s", 1), (401, [2.0, 1.0, 2.0], 2, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in negatives.mine(df, df.where("vec_id % 100 = 0"), negatives.noisy_label()).collect()]
    assert set(got) == brute(rows) and any(r[0] == 0 for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty, empty, negatives.noisy_label()).collect() == []
    assert negatives.mine(df, empty, negatives.noisy_label()).collect() == []


def test_walks_stop_early():
    """Members of a narrow cluster look at a part of the list only, and find what a full look finds."""
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(20000, 3))
    walk = negatives.Walk(np.arange(20000), np.arange(20000) % 2, rows, 256)
    asks = np.array([5.0, 1.0, 0.0]) + rng.normal(size=(20, 3)) * 0.05
    ends = np.full((20, 1), -LONG - 1, dtype=object), np.full((20, 1), LONG, dtype=object)
    hits = walk.search(np.full(20, -1), np.zeros(20, int), asks, np.zeros(20, int), *ends, 5, True)
    assert walk.looked < 20 * 10000 / 3
    scores = np.floor(asks * 256) @ np.floor(rows * 256).T
    by = defaultdict(list)
    for i, _, name, score in hits:
        by[i].append((-score, name))
    for i in range(20):
        assert sorted(by[i]) == sorted((-int(scores[i, j]), j) for j in range(0, 20000, 2))[:5]
