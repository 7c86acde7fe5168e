"""Plans that a hot key or a null key must not spoil, and the spread of products with very many variants."""

import re

import pytest
from pyspark.sql import functions as F

from quayside.operators.lookup import outer_using
from quayside.operators.snapshot import max_over
from quayside.operators.variants import expand_variants, spread_numbers
from quayside.sources.changes import snapshot_diff


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_snapshot_diff_in_one_shuffle(spark, no_broadcast, rows):
    schema = "a int, b string, v int, w array<int>"
    before = spark.createDataFrame([(1, "x", 1, [1]), (None, "x", 2, None), (None, None, 3, []), (2, "y", None, None), (5, "z", 1, None)], schema)
    after = spark.createDataFrame([(1, "x", 1, [1]), (None, "x", 5, None), (None, None, 3, []), (2, "y", None, [2]), (None, "q", 7, None)], schema)
    diff = snapshot_diff(before, after, ["a", "b"])
    got = sorted((r._change_type, str(r.a), str(r.b), str(r.v), str(r.w)) for r in diff.collect())
    assert got == sorted([
        ("delete", "5", "z", "1", "None"), ("insert", "None", "q", "7", "None"), ("update_postimage", "2", "y", "None", "[2]"),
        ("update_postimage", "None", "x", "5", "None"), ("update_preimage", "2", "y", "None", "None"), ("update_preimage", "None", "x", "2", "None"),
    ])
    assert plan(diff).count("Exchange hashpartitioning") == 1 and "FullOuter" not in plan(diff)


def test_max_over_shuffles_each_side_once(spark, no_broadcast):
    df = spark.createDataFrame([(1, None, 5), (1, None, 7), (None, None, 1), (2, "x", None), (2, "y", 3)], "a int, b string, v int")
    top = max_over(df, "v", ["a", "b"], "m")
    assert sorted(map(str, (tuple(r) for r in top.collect()))) == sorted(map(str, [(1, None, 5, 7), (1, None, 7, 7), (None, None, 1, 1), (2, "x", None, None), (2, "y", 3, 3)]))
    assert plan(top).count("Exchange hashpartitioning") == 2


def test_outer_join_splits_a_hot_key(spark, no_broadcast):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        many = spark.range(60000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        few = spark.range(-5, 8000).select(F.col("id").alias("k"), F.lit("p").alias("p"))
        joined = outer_using(many.repartition(6), few.repartition(6), ["k"])
        # every multiple of three is hot, so of the keys below 5000 all still occur: 3 and 5000 have no common divisor
        assert joined.count() == 60000 + 4 + 3000
        joined = outer_using(many.repartition(6), few.repartition(6), ["k"])
        joined.collect()
        final = plan(joined)
        assert "skew=true" in final and "FullOuter" not in final
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_numbers_spread(spark):
    df = spark.createDataFrame([("none", None), ("zero", 0), ("one", 1), ("edge", 1024), ("over", 1025), ("far", 3000)], "p string, n bigint")
    got = spread_numbers(df, F.col("n"), "v").groupBy("p").agg(F.count("v").alias("n"), F.count_distinct("v").alias("d"), F.max("v").alias("m"), F.count(F.lit(1)).alias("r"))
    assert {r.p: (r.n, r.d, r.m, r.r) for r in got.collect()} == {
        "none": (0, 0, None, 1), "zero": (0, 0, None, 1), "one": (1, 1, 0, 1), "edge": (1024, 1024, 1023, 1024), "over": (1025, 1025, 1024, 1025), "far": (3000, 3000, 2999, 3000),
    }
    tiny = spread_numbers(df, F.col("n"), "v", width=4).groupBy("p").agg(F.count_distinct("v").alias("d")).collect()
    assert {r.p: r.d for r in tiny} == {"none": 0, "zero": 0, "one": 1, "edge": 1024, "over": 1025, "far": 3000}


def test_one_product_with_very_many_variants(spark):
    """A million combinations of one product: all there, dealt evenly over the tasks, no value that holds them all."""
    lists = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("o"), k, F.lit("_"), i)))
    df = spark.createDataFrame([("hot",)], "id string").select("id", lists.alias("lists"))
    rows = expand_variants(df, "id", "lists").select("ProductID", F.spark_partition_id().alias("task"))
    tasks = sorted(r["count"] for r in rows.groupBy("task").count().collect())
    assert sum(tasks) == 10**6 and len(tasks) == 4 and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    assert rows.agg(F.approx_count_distinct("ProductID", 0.01)).first()[0] > 960_000
    sizes = [int(x) for x in re.findall(r"size=(\d+)", plan(rows))]
    assert not sizes or max(sizes) < 10**6


def test_products_of_one_file_are_dealt(spark):
    """A short file of products is one split; their variants come from all tasks, in the product job too."""
    from quayside.plans.entities import Rules, product_variants
    from quayside.session import run_dir, stage
    from quayside.workload.nested import variants

    sf = "/root/testdata/sf0.001"
    for made in (
        variants(spark, sf),
        product_variants(
            stage(
                spark.range(200).selectExpr(
                    "'SC-' || id AS ExternalProductID", "'n' AS Name", "'d' AS Description", "'p' AS ReturnPolicyStatement", "1 AS ReturnPolicyPeriodInDays",
                    "'c' AS CatalogId", "'g' AS CategoryId", "array(struct('s' AS ID, 'x' AS Name, array(struct('a' AS ID, 'b' AS Value), struct('c' AS ID, 'd' AS Value)) AS Options)) AS Specs",
                ).coalesce(1),
                run_dir(spark, "few"),
            ),
            Rules(),
        ),
    ):
        counts = [r["count"] for r in made.select(F.spark_partition_id().alias("task"), "ExternalProductID").groupBy("task").count().collect()]
        assert len(counts) >= 4 and max(counts) < sum(counts) / 2
