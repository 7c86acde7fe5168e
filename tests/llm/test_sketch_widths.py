"""The similarity join's sketches: large sets of a family with small ones keep their own width."""

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import jaccard
from quayside.llm.words import mix


def test_large_sets_of_a_long_list_are_told_apart(spark, tmp_path, monkeypatch):
    sizes, sets = [20], []
    while sizes[-1] < 3000:  # each may link with the next by size
        sizes.append(sizes[-1] * 100 // 92)
    at = 1
    for n in sizes:
        sets.append(np.append(mix(np.arange(at, at + n - 1, dtype=np.uint64)), np.uint64(7)))
        at += n
    sets.append(np.append(sets[-1][:-20], mix(np.arange(at, at + 30, dtype=np.uint64))))  # links with the largest
    last = len(sets) - 1
    rows = [(1, 1, k, k, len(s), [7], bytearray(jaccard.sketch(s))) for k, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "la long, lb long, a long, b long, n long, tokens array<long>, sketch binary")
    for family in (jaccard.FAMILY, 8):
        monkeypatch.setattr(jaccard, "FAMILY", family)
        kept = jaccard.passing(table.drop("sketch"), table.select("a", "b", "sketch"), 90)
        assert kept.columns == ["la", "lb", "a", "b", "n", "tokens"]
        assert {r["a"] for r in kept.select("a").where(F.col("a") > 0).collect()} == {last - 1, last}
