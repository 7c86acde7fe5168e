"""The shared pass over several targets against the merges of one target, and the materialised star's plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quayside.operators.merge import MergeSpec, apply_changes, merge_into, merge_shared, src
from quayside.plans.materialized import materialize_star
from quayside.plans.measures import evaluate
from quayside.session import run_dir
from quayside.workload.inputs import star

SF = "/root/testdata/sf0.001"


def listed(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("staged", [False, True])
def test_equals_single_merges(spark, staged):
    rnd = random.Random(3)
    keys = [None, "a", "b", "c", "d", "e", "f"]
    one = spark.createDataFrame([(rnd.choice(keys), i, None) for i in range(8)], "id string, n int, note string")
    two = spark.createDataFrame([("old", k) for k in ["a", "c", "x", None]], "text string, ref string")
    source = spark.createDataFrame([("a", 1, "PUT"), ("b", 2, "DELETE"), ("d", 3, "PUT"), ("g", 4, None), (None, 5, "PUT"), ("h", 6, "PUT"), ("c", 7, "DELETE"), ("i", 8, "PUT")], "k string, v int, Verb string")
    gone = spark.createDataFrame([("a",), ("h",), (None,), ("x",)], "k string")
    specs = {
        "one": MergeSpec.upsert({"id": "k"}, {"n": "v", "note": F.concat(F.lit("n"), src("v").cast("string"))}),
        "two": MergeSpec({"ref": "k"}, update={"text": F.lit("new")}, insert={"ref": "k"}),
    }
    for verb, expired in ((None, None), ("Verb", None), (None, gone), ("Verb", gone)):
        path = run_dir(spark, "shared") if staged else None
        got = merge_shared({"one": one, "two": two}, source, specs, verb=verb, expired=expired, path=path)
        for name, target in (("one", one), ("two", two)):
            s = specs[name]
            if verb:
                want = apply_changes(target, source, s.on, update=s.update, insert=s.insert)
            else:
                want = merge_into(target, source, s.on, update=s.update, insert=s.insert)
            if expired is not None:
                want = merge_into(want, gone, {next(iter(s.on)): "k"}, delete=True)
            assert listed(got[name]) == listed(want) and got[name].schema.names == target.schema.names
        if not staged:
            plan = got["one"]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_composite_keys_and_ambiguity(spark):
    target = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", None, 0)], "x string, y int, v int")
    twice = spark.createDataFrame([("a", 1, 5), ("a", 1, 6)], "x string, y int, w int")
    spec = {"t": MergeSpec.upsert({"x": "x", "y": "y"}, {"v": "w"})}
    with pytest.raises(Exception, match="ambiguous"):
        merge_shared({"t": target}, twice, spec)["t"].collect()
    fresh = spark.createDataFrame([("z", 1, 5), ("z", 1, 6), ("b", None, 7), ("a", 2, 8)], "x string, y int, w int")
    assert listed(merge_shared({"t": target}, fresh, spec)["t"]) == sorted(map(str, [("a", 1, 0), ("a", 2, 8), ("b", None, 0), ("b", None, 7), ("z", 1, 5), ("z", 1, 6)]))
    assert merge_shared({"t": target.limit(0)}, fresh.limit(0), spec)["t"].collect() == []
    with pytest.raises(ValueError, match="share"):
        merge_shared({"t": target, "u": target}, fresh, spec | {"u": MergeSpec.upsert({"x": "x"}, {"v": "w"})})


def test_materialized_star(spark):
    """No shuffle of fact or customers, and fewer files for selected dates."""
    tables = star(spark, SF)
    path = run_dir(spark, "star")
    stored = materialize_star({n: tables[n] for n in ("Order", "IndividualCustomer")}, path, prefix="t_" + path[-12:], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by = evaluate(stored, ["_OrderTotalAmount"], ["IndividualCustomer.Segment"])
        plan = by._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not re.search(r"hashpartitioning\((CustomerId|_fk)", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dates = {"date_from": "1997-03-01", "date_to": "1997-03-31"}
    some = evaluate(stored, ["_OrderTotalAmount", "_OrderTotalAmountPrevPeriod", "_OrderTotalAmountPrevYear"], **dates)
    assert [round(x, 2) for x in some.first()] == [round(x, 2) for x in evaluate(tables, ["_OrderTotalAmount", "_OrderTotalAmountPrevPeriod", "_OrderTotalAmountPrevYear"], **dates).first()]
    assert "PartitionFilters: [isnotnull(_BookedMonth" in some._jdf.queryExecution().executedPlan().toString()
    read = stored["Order"].where("_BookedMonth BETWEEN DATE'1996-03-01' AND DATE'1997-03-31'")
    assert len(read.select(F.input_file_name()).distinct().collect()) < len(stored["Order"].select(F.input_file_name()).distinct().collect()) / 3


def test_source_rows_move_once(spark):
    """The source meets all targets in one shuffle of its own rows; an empty target costs none and takes every row."""
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 5), ("b", 6), (None, 7), (None, 8), ("b", 9)], "k string, v int")
    spec = MergeSpec.upsert({"k": "k"}, {"v": "v"})
    got = merge_shared({"t": target, "u": target}, source, {"t": spec, "u": spec})
    plan = got["t"]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Generate" not in plan[plan.index("Exchange hashpartitioning") :]
    specs = {"t": spec, "e": spec, "n": MergeSpec({"k": "k"}, update={"v": "v"})}
    got = merge_shared({"t": target, "e": target.limit(0), "n": target.limit(0)}, source, specs, empty=["e", "n"])
    assert listed(got["t"]) == listed(merge_into(target, source, "k", update=spec.update, insert=spec.insert))
    assert listed(got["e"]) == listed(source) and got["n"].count() == 0
    assert "Exchange" not in got["e"]._jdf.queryExecution().executedPlan().toString()


def test_first_load_of_lines_moves_nothing(spark):
    from quayside.plans import entities as jobs
    from quayside.workload import bronze
    from quayside.workload.entities import target

    names = ["Order", "Shipment", "OrderStatus", "OrderLine", "OrderLineStatus"]
    run = jobs.Run(staging=run_dir(spark, "orders"))
    done = jobs.run_orders(bronze.orders(spark, SF), {n: target(spark, n) for n in names}, run)
    assert "Exchange" not in done["OrderLine"]._jdf.queryExecution().executedPlan().toString()
    lines = done["OrderLine"].select("OrderId", "OrderLineId", "ProductId", "Quantity")
    given = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "'SC-' || l_orderkey", "concat('SC-', concat_ws('-', l_linenumber, l_partkey, l_suppkey))", "'SC-' || l_partkey", "cast(l_quantity AS decimal(18,2))"
    )
    assert listed(lines) == listed(given)
