"""Operators against brute force, on skewed input, and by the shape of their plans."""

from collections import Counter
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import format_currency, growth, growth_label, item_name, normalize_phone, to_ts
from quayside.operators.lookup import lookup_any, outer_using
from quayside.operators.merge import MergeSpec, apply_changes, merge_into, merge_table, src
from quayside.operators.snapshot import latest_snapshot
from quayside.operators.star import Relationship, path_between, related, related_one
from quayside.operators.variants import expand_variants, option_lists
from quayside.plans.measures import evaluate
from quayside.plans.model import RELATIONSHIPS
from quayside.session import shared_dir
from quayside.sources.changes import append_changes, newest_commit, open_log, open_window, read_changes
from quayside.sources.readers import jdbc_options

TARGET, SOURCE = "k int, v string", "id int, Verb string, w string, at int"
quick = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.integers(0, 4))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def upsert(target, source, **options):
    return merge_into(target, source, {"k": "id"}, update={"v": "w"}, insert={"k": "id", "v": "w"}, **options)


@quick
@given(
    target=st.lists(st.tuples(keys, st.text("ab", max_size=2)), max_size=6, unique_by=lambda r: r[0]),
    source=st.lists(
        st.tuples(keys, st.sampled_from(["PUT", "DELETE", None]), st.text("xy", max_size=2), st.integers(0, 3)),
        max_size=6,
        unique_by=lambda r: r[0],
    ),
    small=st.booleans(),
)
def test_apply_changes_is_upsert_then_delete(spark, target, source, small):
    t, s = spark.createDataFrame(target, TARGET), spark.createDataFrame(source, SOURCE)
    rows = len(source) if small else None
    one = apply_changes(t, s, {"k": "id"}, update={"v": "w"}, insert={"k": "id", "v": "w"}, source_rows=rows)
    two = merge_into(
        upsert(t, s.where("Verb <> 'DELETE'")), s.where("Verb = 'DELETE'"), {"k": "id"}, delete=True, source_rows=rows
    )
    want = Counter()
    new = {k: (verb, w) for k, verb, w, _ in source if k is not None and verb}
    for k, v in target:
        verb, w = new.get(k, (None, None))
        if verb != "DELETE":
            want[(k, w if verb else v)] += 1
    known = {k for k, _ in target if k is not None}
    for k, verb, w, _ in source:
        if verb == "PUT" and k not in known:
            want[(k, w)] += 1
    assert bag(one) == bag(two) == want


@quick
@given(
    rows=st.lists(
        st.tuples(keys, st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 2), st.integers(0, 99)), max_size=12
    )
)
def test_latest_snapshot_is_the_two_step_form(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, ver int, id int")
    want = []
    for k in {r[0] for r in rows} - {None}:
        mine = [r for r in rows if r[0] == k and r[1] is not None]
        top = [r for r in mine if r[1] == max(m[1] for m in mine)]
        want += [r for r in top if r[2] == max(m[2] for m in top)]
    got = latest_snapshot(df, "k", ["ts", "ver"])
    assert bag(got) == Counter(want)
    one = latest_snapshot(df, "k", ["ts", "ver"], ties="one", tiebreak=["id"]).collect()
    assert {r.k: r.id for r in one} == {k: max(r[3] for r in want if r[0] == k) for k in {r[0] for r in want}}
    assert len(one) == len({r[0] for r in want})


def test_merge_rules_on_ambiguity(spark):
    t = spark.createDataFrame([(1, "a")], TARGET)
    twice = spark.createDataFrame([(1, "PUT", "x", 1), (1, "PUT", "y", 2)], SOURCE)
    with pytest.raises(Exception, match="ambiguous"):
        upsert(t, twice).collect()
    assert bag(upsert(t, twice, on_ambiguous="latest", order=["at"])) == {(1, "y"): 1}
    # several rows for an unmatched key are all inserted, and a delete may match several times
    others = twice.withColumn("id", F.lit(2))
    assert bag(upsert(t, others)) == {(1, "a"): 1, (2, "x"): 1, (2, "y"): 1}
    assert bag(merge_into(t, twice, {"k": "id"}, delete=True)) == {}
    with pytest.raises(ValueError):
        upsert(t, twice, on_ambiguous="any").collect()


def test_merge_with_expressions_partial_insert_and_self_source(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], TARGET)
    s = t.where("k = 2").withColumn("k", F.col("k") + 1).unionByName(t.where("k = 1"))
    merged = merge_into(t, s, "k", update={"v": F.concat(src("v"), F.lit("!"))}, insert={"k": "k"})
    assert bag(merged) == {(1, "a!"): 1, (2, "b"): 1, (3, None): 1}
    assert bag(merge_into(t, t.where("k = 1"), "k", delete=True)) == {(2, "b"): 1}


def test_small_source_leaves_the_target_unshuffled(spark):
    t = spark.range(1000).selectExpr("cast(id as int) AS k", "'v' AS v")
    s = spark.range(50).selectExpr("cast(id * 3 as int) AS id", "'PUT' AS Verb", "'w' AS w", "1 AS at")
    text = plan(upsert(t, s, source_rows=50, on_ambiguous="assume_unique"))
    assert "SortMergeJoin" not in text
    # only distinct keys are exchanged, never the value column of the target
    assert not [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "v#" in line]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows share one key: one row per task and key reaches the shuffle."""
    hot = spark.range(30_000).selectExpr(
        "cast(if(id % 3 = 0, 0, id) as int) AS k", "cast(id % 100 as int) AS ts", "1 AS ver", "cast(id as int) AS id"
    )
    one = latest_snapshot(hot, "k", ["ts", "ver"], ties="one", tiebreak=["id"])
    assert "WindowGroupLimit" in plan(one) and plan(one).count("Exchange hashpartitioning") == 1
    assert one.where("k = 0").first().id == max(i for i in range(0, 30_000, 3) if i % 100 == 99)
    kept = latest_snapshot(hot, "k", ["ts", "ver"])
    assert kept.where("k = 0").count() == sum(1 for i in range(0, 30_000, 3) if i % 100 == 99)
    assert kept.count() == 20_000 + 100


def test_skewed_merge_splits_the_hot_partition(spark):
    """With every row of a large target on one key the update join is still split."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(200_000).selectExpr("cast(if(id % 3 > 0, 7, id) as int) AS k", "uuid() AS v")
        path = f"{shared_dir(spark)}/hot"
        hot.write.mode("overwrite").parquet(path)
        s = spark.range(1000).selectExpr("cast(id as int) AS id", "'PUT' AS Verb", "'w' AS w", "1 AS at")
        merged = merge_into(spark.read.parquet(path), s, {"k": "id"}, update={"v": "w"}, on_ambiguous="assume_unique")
        merged.write.format("noop").mode("overwrite").save()
        assert merged.where("k = 7 AND v = 'w'").count() >= 133_000
        merged.collect()
        assert "skew=true" in plan(merged)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@quick
@given(lists=st.lists(st.lists(st.sampled_from("abc"), max_size=3, unique=True), max_size=3))
def test_variants_are_the_cartesian_product(spark, lists):
    df = spark.createDataFrame([("P", lists)], "id string, lists array<array<string>>")
    got = [r.ProductID for r in expand_variants(df, "id", "lists").collect()]
    combos = ["-".join(("P", *c)) for c in product(*lists)] if lists else []
    assert Counter(got) == Counter(combos or [None])


def test_option_lists_are_sorted_and_distinct(spark):
    specs = [("b", [("y", "1"), (None, "2")]), ("a", [("y", "3")]), ("c", [("x", "4")]), ("d", None)]
    df = spark.createDataFrame([(specs,)], "Specs array<struct<ID:string,Options:array<struct<ID:string,Value:string>>>>")
    assert df.select(option_lists("Specs")).first()[0] == [["x"], ["y"]]


def test_lookup_and_outer_join(spark):
    a = spark.createDataFrame([("us",), ("FRA",), ("zz",), (None,)], "c string")
    d = spark.createDataFrame([(1, "US", "USA"), (2, "FR", "FRA"), (3, "XX", "XX")], "id int, i2 string, i3 string")
    got = lookup_any(a, d, "c", ["i2", "i3"], ["id"])
    assert bag(got) == {("us", 1): 1, ("FRA", 2): 1, ("zz", None): 1, (None, None): 1}
    assert "NestedLoop" not in plan(got)
    left = spark.createDataFrame([(1, "l"), (None, "n")], "k int, a string")
    right = spark.createDataFrame([(2, "r"), (None, "m")], "k int, b string")
    assert bag(outer_using(left, right, ["k"])) == {
        (1, "l", None): 1, (2, None, "r"): 1, (None, "n", None): 1, (None, None, "m"): 1,
    }


def test_relationships(spark):
    assert len(RELATIONSHIPS) == 36
    assert sum(r.both for r in RELATIONSHIPS) == 12 and sum(r.one_to_one for r in RELATIONSHIPS) == 7
    assert sum(r.day_only for r in RELATIONSHIPS) == 13 and sum(not r.active for r in RELATIONSHIPS) == 1
    path = [s.end_table for s in path_between(RELATIONSHIPS, "Order", "Country")]
    assert path == ["IndividualCustomer", "CustomerLocation", "Location", "Country"]
    with pytest.raises(ValueError):
        path_between(RELATIONSHIPS, "Order", "ProductCategory")
    one = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "c")], "k int, w string")
    with pytest.raises(Exception, match="not unique"):
        related_one(one, two, Relationship("A", "k", "B", "k", one_to_one=True)).collect()
    with pytest.raises(ValueError):
        related(one, two, Relationship("A", "k", "B", "k", active=False), ["w"])


def test_small_functions(spark):
    df = spark.createDataFrame(
        [(150.0, 100.0), (0.0, 100.0), (None, 100.0), (100.0, None), (100.0, 100.0), (5.0, 0.0)], "c double, p double"
    )
    got = [tuple(r) for r in df.select(growth("c", "p"), growth_label(growth("c", "p"))).collect()]
    assert got == [(0.5, "↗ 50%"), (-1.0, "↘ 100%"), (-1.0, "↘ 100%"), (None, ""), (0.0, None), (None, "")]
    money = spark.createDataFrame([(1234.5, "$1,235"), (-1234.4, "($1,234)"), (-0.2, "$0"), (0.0, "$0")], "v double, s string")
    assert all(r[0] == r[1] for r in money.select(format_currency("v"), "s").collect())
    assert money.select(format_currency("v", 4, optional=True)).first()[0] == "$1,234.5"
    phones = spark.createDataFrame([("+1 415 555",), ("0014155550100",), ("555-1",), (None,)], "p string")
    assert [r[0] for r in phones.select(normalize_phone("p").cast("int")).collect()] == [1415555, None, None, None]
    junk = spark.createDataFrame([("junk",)], "s string")
    assert junk.select(to_ts("s")).first()[0] is None
    named = spark.createDataFrame([("n", None, ["s"]), ("n", ["v"], ["s"]), ("n", None, [])], "n string, v array<string>, s array<string>")
    assert [r[0] for r in named.select(item_name("n", "v", "s")).collect()] == [None, "n-v", "n"]


def test_log_reads_only_new_versions(spark, tmp_path):
    df = spark.range(3).selectExpr("id")
    for version in (1, 2, 3):
        append_changes(df, str(tmp_path / "log"), version)
    append_changes(df.limit(1), str(tmp_path / "log"), 3)  # a retried batch replaces itself
    new = read_changes(open_log(spark, str(tmp_path / "log"), df.schema), 2)
    assert new.count() == 4
    assert "PartitionFilters: [isnotnull(_commit_version" in plan(new)


def test_metrics_read_only_their_columns(spark):
    from quayside.workload.inputs import star

    df = evaluate(star(spark, "/root/testdata/sf0.001"), ["_OrderTotalAmount"], ["IndividualCustomer.Segment"])
    text = plan(df)
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "NestedLoop" not in text and "EvalPython" not in text


def test_orders_without_a_date_count_in_the_blank_cell(spark):
    orders = spark.createDataFrame(
        [(1, 1, "2024-01-01", 10.0, 1), (2, 1, "2024-03-01", 20.0, 3), (3, 2, None, 5.0, 2)],
        "OrderId int, CustomerId int, day string, OrderTotalAmount double, NumberOfOrderLines int",
    ).withColumn("OrderBookedDate", F.to_timestamp("day"))
    tables = {"Order": orders, "IndividualCustomer": spark.createDataFrame([(1,), (2,), (3,)], "CustomerId int")}
    got = bag(evaluate(tables, ["_OrderTotalAmount", "_AvgBasketSize"], ["Date.MonthNo"]))
    assert got == {(1, 10.0, 1.0): 1, (2, 0.0, None): 1, (3, 20.0, 3.0): 1, (None, 5.0, 2.0): 1}
    counts = evaluate(tables, ["_CountRepeatCustomers", "_CountNewCustomers", "_CountCustomersWithOrders"]).first()
    assert tuple(counts) == (1, 2, 2)
    in_march = evaluate(tables, ["_CountNewCustomers", "_OrderTotalAmount"], date_from="2024-03-01", date_to="2024-03-31")
    assert tuple(in_march.first()) == (0, 20.0)


def test_options_for_a_database_scan():
    options = jdbc_options("jdbc:x", "dbo", "Order", split_column="OrderTypeId", lower=0, upper=9, partitions=8)
    assert options["dbtable"] == '"dbo"."Order"' and options["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "dbo", "Order", split_column="a")


def test_no_machine_local_folder_on_a_cluster(spark):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value

    class Cluster:
        class sparkContext:
            master = "spark://host:1"

        def __init__(self, value):
            self.conf = Conf(value)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster(None))
    assert shared_dir(Cluster("hdfs://x/y/")) == "hdfs://x/y"


def test_in_place_merge_needs_a_row_level_format(spark):
    t = spark.createDataFrame([(1, "a")], TARGET)
    s = spark.createDataFrame([(1, "PUT", "x", 1)], SOURCE)
    t.write.mode("overwrite").format("parquet").saveAsTable("quayside_rowlevel")
    try:
        with pytest.raises(Exception, match="MERGE INTO TABLE|UNSUPPORTED_FEATURE"):
            merge_table(s, "quayside_rowlevel", MergeSpec.upsert({"k": "id"}, {"v": "w"}), delete_verb="Verb")
    finally:
        spark.sql("DROP TABLE quayside_rowlevel")


def shops(spark, repeated):
    """Three orders: of a customer in France, of one whose place has no country, and of one without a place."""
    rows = lambda data, kinds: spark.createDataFrame(data, kinds)
    return {
        "Order": rows([(1, "a", "2024-01-05", 10.0), (2, "b", "2024-01-06", 20.0), (3, "c", "2024-01-07", 40.0)],
                      "OrderId long, CustomerId string, OrderBookedDate string, OrderTotalAmount double"),
        "IndividualCustomer": rows([("a",), ("b",), ("c",)], "CustomerId string"),
        "CustomerLocation": rows([("a", "p"), ("b", "q")] + [("a", "p")] * repeated, "CustomerId string, LocationId string"),
        "Location": rows([("p", 1), ("q", None)], "LocationId string, CountryId long"),
        "Country": rows([(1, "France"), (2, "Spain")], "CountryId long, IsoCountryName string"),
    }


def test_blank_is_a_value_to_filter_by(spark):
    total = lambda wanted: evaluate(shops(spark, 0), ["_OrderTotalAmount"], where={"Country.IsoCountryName": wanted}).first()[0]
    assert (total([None]), total(["France"]), total(["France", None]), total(["Spain"])) == (60.0, 10.0, 70.0, 0.0)


def test_repeated_one_side_fails(spark):
    with pytest.raises(Exception, match="not unique"):
        evaluate(shops(spark, 1), ["_OrderTotalAmount"], ["Country.IsoCountryName"]).collect()


def test_newest_commit_is_a_finished_one(spark, tmp_path):
    log = str(tmp_path / "log")
    assert newest_commit(spark, log) == 0
    for version in (1, 2, 11):
        append_changes(spark.range(version), log, version)
    (tmp_path / "log" / "_commit_version=12").mkdir()
    assert newest_commit(spark, log) == 11
    window = open_window(spark, log, spark.range(1).schema, 2, 11)
    assert Counter(r["_commit_version"] for r in window.collect()) == {2: 2, 11: 11}
    assert open_window(spark, log, spark.range(1).schema, 3, 9).collect() == []
