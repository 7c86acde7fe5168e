"""Line dedup: edits are verified on the texts, and short lines are compared when the caller asks for it."""

import random

from pyspark.sql import functions as F

from quayside.llm import lines


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def dedup(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.text for r in lines.dedup_lines(docs, **options).collect()}


def test_short_lines(spark):
    assert dedup(spark, ["abcdefghijk", "abcdefghijX"]) == {0: "abcdefghijk", 1: "abcdefghijX"}
    assert dedup(spark, ["abcdefghijk", "abcdefghijX"], shortest=1) == {0: "abcdefghijk", 1: ""}


def test_lines_of_any_length_against_brute_force(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(250)]
    texts += [t[: len(t) // 2] + "z" + t[len(t) // 2 + rnd.randint(0, 1) :] for t in rnd.choices(texts, k=80)]
    want = {i: "" if any(near(t, u) for u in texts[:i]) else t for i, t in enumerate(texts)}
    assert dedup(spark, texts, shortest=1) == want


def test_very_long_lines(spark):
    long = "word " * 20_000
    assert dedup(spark, [long + "end", long + "and", long + "other end"]) == {0: long + "end", 1: "", 2: long + "other end"}


def test_clash_of_hashes_keeps_the_line(spark):
    shape = "h1 long, h2 long, place struct<id:long,twin:long,line_no:int>, form string"
    forms = spark.createDataFrame([(1, 1, (None, 5, 0), "a line of the first"), (2, 2, (1, 6, 0), "a line of the fist"), (3, 3, (2, 7, 0), "nothing alike")], shape)
    late = forms.where("h1 > 1").select("h1", "h2", F.struct(F.lit(None).cast("long").alias("id"), F.lit(5).cast("long").alias("twin"), F.lit(0).alias("line_no")).alias("before"))
    assert [r.h1 for r in lines.verified(late, forms).collect()] == [2]
