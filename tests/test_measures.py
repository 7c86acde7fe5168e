"""Periods by spans of days, customer counts that roll up, filters and summaries over the whole model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.bitmaps import counted, member_bitmaps, merge_bitmaps, number_members, rollup_bitmaps
from quayside.operators.star import Relationship, propagate_all
from quayside.plans.measures import customers_rollup, day_roles, day_spans, evaluate, summaries
from quayside.workload.inputs import star

SF = "/root/testdata/sf0.001"


def test_spans_stand_for_their_days(spark):
    """Handing a span's uses to each of its days gives the day table again; months need few spans."""
    bounds = spark.sql("SELECT DATE '2020-01-15' AS lo, DATE '2022-03-10' AS hi")
    for by in (["Year", "MonthNo"], ["MonthNo"], [], ["Date"]):
        cells = day_roles(bounds, by, ["cur", "prev", "year"])
        days, uses = day_spans(cells)
        assert days.count() == cells.select("_day").distinct().count()
        back = days.join(uses, "_span").drop("_span").select(*cells.columns)
        order = lambda df: sorted(map(str, df.collect()))
        assert order(back) == order(cells)
        if by == ["Year", "MonthNo"]:
            assert days.select("_span").distinct().count() < 5 * 27


def test_order_rows_are_summed_before_the_roles(spark):
    """No row of the fact passes a join that may copy it: the only join above the fact's aggregate is that of the spans."""
    names = ["_OrderTotalAmount", "_OrderTotalAmountGrowth", "_OrderTotalAmountPrevYear", "_AvgBasketSizeGrowth"]
    plan = evaluate(star(spark, SF, lines=True), names, ["Date.Year", "Date.Quarter"])._jdf.queryExecution().optimizedPlan().toString()
    fact = next(line for line in plan.splitlines() if "Aggregate" in line and "OrderTotalAmount" in line and "_span" in line and "__s" in line)
    above = plan[: plan.index(fact)]
    assert above.count("Aggregate") >= 1 and "cur" in above


def test_blank_days_and_gaps(spark):
    """Orders without a date, days without orders, and a month cell over several years."""
    rows = [("1", "c", dt.datetime(2020, 1, 5), 10.0, 1), ("2", "c", None, 7.0, 2), ("3", "d", dt.datetime(2021, 1, 20), 5.0, 1), ("4", "d", dt.datetime(2021, 2, 3), 1.0, 4)]
    orders = spark.createDataFrame(rows, "OrderId string, CustomerId string, OrderBookedDate timestamp, OrderTotalAmount double, NumberOfOrderLines int")
    got = evaluate({"Order": orders}, ["_OrderTotalAmount", "_OrderTotalAmountPrevYear", "_AvgBasketSize"], ["Date.MonthNo"]).collect()
    found = {r.MonthNo: (r["_OrderTotalAmount"], r["_OrderTotalAmountPrevYear"], r["_AvgBasketSize"]) for r in got}
    # the fifth of January 2020 lies 365 days before the fourth of January 2021
    assert found[1] == (15.0, 10.0, 1.0) and found[2] == (1.0, None, 4.0) and found[None] == (7.0, None, 2.0)
    assert found[3] == (0.0, None, None)


def test_numbers_are_dense_and_counts_merge(spark):
    rows = spark.range(5000).selectExpr("concat('c', id % 700) AS c", "id % 9 AS g", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 50) END AS s")
    numbers = number_members(rows.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS c, 0L AS g, 's' AS s")), "c", ranges=16)
    assert sorted(r._number for r in numbers.collect()) == list(range(700))
    bits = member_bitmaps(rows.join(numbers, "c"), ["s", "g"])
    fine = {(r.s, r.g): r.n for r in bits.groupBy("s", "g").agg(counted().alias("n")).collect()}
    coarse = {r.s: r.n for r in merge_bitmaps(bits, ["s"]).groupBy("s").agg(counted().alias("n")).collect()}
    assert fine == {(r.s, r.g): r.n for r in rows.groupBy("s", "g").agg(F.count_distinct("c").alias("n")).collect()}
    assert coarse == {r.s: r.n for r in rows.groupBy("s").agg(F.count_distinct("c").alias("n")).collect()}
    levels = rollup_bitmaps(bits, ["s", "g"]).groupBy("s", "g", "_level").agg(counted().alias("n"))
    assert levels.where("_level = 0").first().n == 700 and levels.where("_level = 1").count() == len(coarse)
    assert rollup_bitmaps(bits.limit(0), ["s", "g"]).count() == 0


def test_customers_roll_up_with_a_filter(spark):
    tables = star(spark, SF)
    got = customers_rollup(tables, where={"IndividualCustomer.Segment": ["BUILDING"]}).where("level = 0").first()
    orders, customers = tables["Order"], tables["IndividualCustomer"].where("Segment = 'BUILDING'")
    per = orders.join(customers, "CustomerId").groupBy("CustomerId").count()
    assert got["_CountCustomersWithOrders"] == per.count() and got["_CountRepeatCustomers"] == per.where("count > 1").count()


def test_filters_reach_what_exists_allows(spark):
    """Random small tables on a tree with edges both ways and one way, against plain loops."""
    rnd = random.Random(7)
    rels = [Relationship("f", "a", "d", "a", both=True), Relationship("f", "b", "e", "b"), Relationship("g", "a", "d", "a"), Relationship("d", "c", "h", "c", both=True)]
    columns = {"f": "ab", "d": "ac", "e": "b", "g": "a", "h": "c"}
    for _ in range(3):
        data = {t: [tuple([rnd.choice([0, 1, 2, 3, None]) for _ in cs] + [rnd.random() < 0.6]) for _ in range(6)] for t, cs in columns.items()}
        tables = {t: spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns[t]) + ", ok boolean") for t, rows in data.items()}
        filtered = rnd.sample(sorted(columns), 3)
        got = propagate_all(tables, rels, {t: F.col("ok") for t in filtered})

        def kept(table, came=None):
            out = []
            for row in data[table]:
                good = row[-1] if table in filtered else True
                for r in rels:
                    for mine, mc, other, oc, way in ((r.from_table, r.from_column, r.to_table, r.to_column, True), (r.to_table, r.to_column, r.from_table, r.from_column, r.both)):
                        if mine == table and way and other != came and reaches(other, table):
                            value = row[columns[table].index(mc)]
                            good = good and value is not None and any(o[columns[other].index(oc)] == value for o in kept(other, table))
                out += [row] if good else []
            return out

        def reaches(table, came):
            """Is there a filter in the branch behind an edge that leads to ``came``?"""
            ways = [(r.to_table, True) for r in rels if r.from_table == table] + [(r.from_table, r.both) for r in rels if r.to_table == table]
            return table in filtered or any(way and t != came and reaches(t, table) for t, way in ways)

        for t in columns:
            assert sorted(map(str, (tuple(r) for r in got[t].collect()))) == sorted(map(str, kept(t))), (t, filtered)


def test_summaries_over_facts(spark):
    tables = star(spark, SF, lines=True)
    with pytest.raises(ValueError, match="no fact"):
        summaries(tables, ["Order.OrderTotalAmount"], ["ProductCategory.ProductCategoryName"])
    with pytest.raises(ValueError, match="no default summary"):
        summaries(tables, ["Order.CustomerId"], ["IndividualCustomer.Segment"])
    rows = summaries(tables, ["OrderLine.Quantity", "Order.OrderTotalAmount"], ["ProductCategory.ProductCategoryName", "IndividualCustomer.Segment"]).collect()
    by_segment = {(r.Segment, r.OrderTotalAmount) for r in rows}
    assert len(by_segment) == len({r.Segment for r in rows})  # repeated over product types, not divided by them
