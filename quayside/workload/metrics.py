"""The nineteen measures and the calculated columns over the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.plans.measures import (
    add_hasmultipleorders,
    add_orderbookeddate,
    add_repeatornewcustomer,
    customers_rollup,
    evaluate,
)
from quayside.plans.materialized import materialize_star
from quayside.plans.model import add_orderstatusforsalesrevenue
from quayside.session import run_dir
from quayside.workload import query
from quayside.workload.inputs import STAR_SQL, star

ROUND = 6


def _rounded(df):
    """Ratios and means to six digits, as in the SQL."""
    return df.select([F.round(c, ROUND).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def run(measures, by=(), **filters):
    lines = any("Basket" in m for m in measures)

    def query_(spark, sf):
        return _rounded(evaluate(star(spark, sf, lines=lines), measures, by, **filters))

    return query_


# ---- cells in SQL --------------------------------------------------------------

CUSTOMER_SQL = 'JOIN customer ON c_custkey = "CustomerId" JOIN nation ON n_nationkey = c_nationkey'
BASE = f"""{STAR_SQL}, f AS (SELECT o.*, c_mktsegment AS "Segment", n_name AS "IsoCountryName" FROM o {CUSTOMER_SQL}),
  days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM o)"""


def period_sql(keys: str, attrs: str, select: str, dims: str = "", date: str = "true", roles: str = "'cur'") -> str:
    """Cells by date attributes (and dimensions) with their current, previous and last-year values.

    ``keys`` names the date attributes, ``attrs`` computes them from d, ``dims`` adds columns of the fact.
    Only the periods in ``roles`` are read, so only their rows make a cell appear.
    """
    names = [k for k in keys.split(",") if k]
    dim_names = [k for k in dims.split(",") if k]
    cell_cols = "".join(f"{k}, " for k in names)
    every = names + dim_names
    out = "".join(f"{k}, " for k in every)
    group = f"GROUP BY {', '.join(every)}" if every else ""
    cell_group = f"GROUP BY {', '.join(names)}" if names else ""
    match = " AND ".join(f"s.{k} = c.{k}" for k in names) or "true"
    fact_dims = "".join(f", f.{k}" for k in dim_names)
    zero_dims = "".join(", NULL" for _ in dim_names)
    blank = (
        f"UNION ALL SELECT {''.join(f'c.{k}, ' for k in names)}lo, hi, 'cur', NULL, NULL{zero_dims} FROM cells c"
        if not dims
        else ""
    )
    named = f"{attrs}, " if attrs else ""
    return f"""WITH {BASE}, sel AS (SELECT d, {named}0 AS z FROM days WHERE {date}),
    cells AS (SELECT {cell_cols}min(d) AS lo, max(d) AS hi, date_diff('day', min(d), max(d)) + 1 AS n FROM sel {cell_group}),
    m AS (SELECT s.*, lo, hi, n FROM sel s JOIN cells c ON {match}),
    r AS (SELECT {''.join(f'm.{k}, ' for k in names)}lo, hi, 'cur' AS role, m.d AS day FROM m
      UNION ALL SELECT {''.join(f'm.{k}, ' for k in names)}lo, hi, 'prev', CAST(m.d - CAST(n AS INTEGER) AS DATE) FROM m
        WHERE CAST(m.d - CAST(n AS INTEGER) AS DATE) IN (SELECT d FROM days)
      UNION ALL SELECT {''.join(f'm.{k}, ' for k in names)}lo, hi, 'year', CAST(m.d - 365 AS DATE) FROM m
        WHERE CAST(m.d - 365 AS DATE) IN (SELECT d FROM days)),
    x AS (SELECT {''.join(f'r.{k}, ' for k in names)}lo, hi, role, amt, lines{fact_dims} FROM r JOIN f ON f.d = r.day
      WHERE role IN ({roles}) {blank}),
    g AS (SELECT {out}min(lo) AS lo, max(hi) AS hi,
      CAST(sum(amt) FILTER (WHERE role = 'cur') AS DOUBLE) AS cur, CAST(sum(amt) FILTER (WHERE role = 'prev') AS DOUBLE) AS prev,
      CAST(sum(amt) FILTER (WHERE role = 'year') AS DOUBLE) AS py,
      CAST(sum(amt) FILTER (WHERE role = 'cur') AS DOUBLE) / count(amt) FILTER (WHERE role = 'cur') AS acur,
      CAST(sum(amt) FILTER (WHERE role = 'prev') AS DOUBLE) / nullif(count(amt) FILTER (WHERE role = 'prev'), 0) AS aprev,
      CAST(sum(lines) FILTER (WHERE role = 'cur') AS DOUBLE) / count(lines) FILTER (WHERE role = 'cur') AS bcur,
      CAST(sum(lines) FILTER (WHERE role = 'prev') AS DOUBLE) / nullif(count(lines) FILTER (WHERE role = 'prev'), 0) AS bprev
      FROM x {group}),
    q AS (SELECT *, (coalesce(cur, 0) - prev) / nullif(prev, 0) AS gt, (coalesce(acur, 0) - aprev) / nullif(aprev, 0) AS ga,
      (coalesce(bcur, 0) - bprev) / nullif(bprev, 0) AS gb FROM g)
    SELECT {out}{select} FROM q"""


def label_sql(g: str) -> str:
    return f"""CASE WHEN {g} IS NULL THEN '' WHEN {g} < 0 THEN '↘ ' || CAST(round({g} * -100, 0) AS BIGINT)::VARCHAR || '%'
      WHEN {g} > 0 THEN '↗ ' || CAST(round({g} * 100, 0) AS BIGINT)::VARCHAR || '%' END"""


VALUES = {
    "_OrderTotalAmount": "round(coalesce(cur, 0), 6)",
    "_AvgOrderTotalAmount": "round(acur, 6)",
    "_AvgBasketSize": "round(bcur, 6)",
    "_DateRangeLabel": "strftime(lo, '%-m/%-d/%Y') || ' - ' || strftime(hi, '%-m/%-d/%Y')",
    "_DaysInDateRangeFilter": "CAST(date_diff('day', lo, hi) + 1 AS INTEGER)",
    "_OrderTotalAmountPrevPeriod": "round(prev, 6)",
    "_OrderTotalAmountPrevYear": "round(py, 6)",
    "_OrderTotalAmountGrowth": "round(gt, 6)",
    "_OrderTotalAmountGrowthLabel": label_sql("gt"),
    "_AvgOrderTotalAmountPrevPeriod": "round(aprev, 6)",
    "_AvgOrderTotalAmountGrowth": "round(ga, 6)",
    "_AvgOrderTotalAmountGrowthLabel": label_sql("ga"),
    "_AvgBasketSizePrevPeriod": "round(bprev, 6)",
    "_AvgBasketSizeGrowth": "round(gb, 6)",
    "_AvgBasketSizeGrowthLabel": label_sql("gb"),
}


def select_sql(measures) -> str:
    return ", ".join(f'{VALUES[m]} AS "{m}"' for m in measures)


DATE_PARTS = {
    "Year": 'CAST(year(d) AS INTEGER) AS "Year"',
    "MonthNo": 'CAST(month(d) AS INTEGER) AS "MonthNo"',
    "Quarter": "'Qtr ' || quarter(d)::VARCHAR AS \"Quarter\"",
    "Date": 'd AS "Date"',
}


def periods(name: str, measures: list[str], dates: list[str], dims: list[str] = (), date: str = "true", **filters) -> None:
    """Register measures over cells of date attributes, and of dimensions of the star."""
    roles = ["'cur'"]
    roles += ["'prev'"] if any("PrevPeriod" in m or "Growth" in m for m in measures) else []
    roles += ["'year'"] if any("PrevYear" in m for m in measures) else []
    sql = period_sql(
        ",".join(f'"{k}"' for k in dates),
        ", ".join(DATE_PARTS[k] for k in dates),
        select_sql(measures),
        ",".join(f'"{d.split(".")[1]}"' for d in dims),
        date,
        ", ".join(roles),
    )
    query(name, sql)(run(measures, [f"Date.{k}" for k in dates] + list(dims), **filters))


MONTH = ["Year", "MonthNo"]
TOTALS = ["_OrderTotalAmount", "_OrderTotalAmountPrevPeriod", "_OrderTotalAmountGrowth", "_OrderTotalAmountGrowthLabel"]
MEANS = [
    "_AvgOrderTotalAmount", "_AvgOrderTotalAmountPrevPeriod", "_AvgOrderTotalAmountGrowth",
    "_AvgOrderTotalAmountGrowthLabel",
]
BASKETS = ["_AvgBasketSize", "_AvgBasketSizePrevPeriod", "_AvgBasketSizeGrowth", "_AvgBasketSizeGrowthLabel"]
RANGE = {"date_from": "1997-03-01", "date_to": "1997-08-31"}
RANGE_SQL = "d BETWEEN DATE '1997-03-01' AND DATE '1997-08-31'"

periods("kpi_growth_by_month", TOTALS, MONTH)
periods("kpi_average_growth_by_month", MEANS, MONTH)
periods("kpi_basket_growth_by_month", BASKETS, MONTH)
periods("kpi_prev_year_by_month", ["_OrderTotalAmount", "_OrderTotalAmountPrevYear"], MONTH)
periods("kpi_range_label_by_quarter", ["_DateRangeLabel", "_DaysInDateRangeFilter"], ["Year", "Quarter"])
periods("kpi_growth_by_day", TOTALS, ["Date"])
periods("kpi_growth_by_month_and_segment", TOTALS, MONTH, ["IndividualCustomer.Segment"])
periods("kpi_prev_year_by_year_and_country", ["_OrderTotalAmountPrevYear", "_OrderTotalAmount"], ["Year"], ["Country.IsoCountryName"])
periods("kpi_selected_period", [*TOTALS, "_DateRangeLabel", "_DaysInDateRangeFilter"], [], [], RANGE_SQL, **RANGE)
periods("kpi_all_order_measures", list(VALUES), ["Year", "Quarter"])


_selected = [*TOTALS, "_OrderTotalAmountPrevYear", "_DateRangeLabel"]


@query("kpi_materialized", period_sql("", "", select_sql(_selected), '"Segment"', RANGE_SQL, "'cur', 'prev', 'year'"))
def materialized(spark, sf):
    """Selected dates by segment over the materialised star: months outside are not opened, the join needs no shuffle."""
    path = run_dir(spark, "star")
    tables = star(spark, sf)
    some = {n: tables[n] for n in ("Order", "IndividualCustomer")}
    stored = materialize_star(some, path, prefix=path.rsplit("/", 1)[1].replace("-", "_"), buckets=4)
    return _rounded(evaluate(stored, _selected, ["IndividualCustomer.Segment"], **RANGE))


def simple(name: str, by: list[str], key: str, where_sql: str = "true", extra: str = "", **filters) -> None:
    group = f"GROUP BY {key}" if key else ""
    head = f"{key}, " if key else ""
    query(
        name,
        f"""WITH {BASE} SELECT {head}round(coalesce(CAST(sum(amt) AS DOUBLE), 0), 6) AS "_OrderTotalAmount",
        round(CAST(sum(amt) AS DOUBLE) / nullif(count(amt), 0), 6) AS "_AvgOrderTotalAmount",
        round(CAST(sum(lines) AS DOUBLE) / nullif(count(lines), 0), 6) AS "_AvgBasketSize"
        FROM f {extra} WHERE {where_sql} {group}""",
    )(run(["_OrderTotalAmount", "_AvgOrderTotalAmount", "_AvgBasketSize"], by, **filters))


simple("kpi_overall", [], "")
simple("kpi_by_segment", ["IndividualCustomer.Segment"], '"Segment"')
simple("kpi_by_country", ["Country.IsoCountryName"], '"IsoCountryName"')
simple(
    "kpi_by_group",
    ["CustomerGroup.CustomerGroupId"],
    '"CustomerGroupId"',
    extra='JOIN (SELECT DISTINCT c_mktsegment AS "CustomerGroupId" FROM customer) ON "CustomerGroupId" = "Segment"',
)
simple(
    "kpi_filtered_by_country",
    ["IndividualCustomer.Segment"],
    '"Segment"',
    "\"IsoCountryName\" IN ('NATION_1', 'NATION_2')",
    where={"Country.IsoCountryName": ["NATION_1", "NATION_2"]},
)


@query(
    "kpi_by_status",
    f"""WITH {BASE} SELECT CASE status WHEN 3 THEN 'Open' WHEN 4 THEN 'Completed' ELSE 'AwaitingApproval' END
       AS "OrderStatusTypeName", round(CAST(sum(amt) AS DOUBLE), 6) AS "_OrderTotalAmount" FROM f GROUP BY 1""",
)
def by_status(spark, sf):
    return _rounded(evaluate(star(spark, sf), ["_OrderTotalAmount"], ["OrderStatusType.OrderStatusTypeName"]))


@query(
    "kpi_by_order_type",
    f"""WITH {BASE} SELECT 'Online Sale' AS "OrderTypeName", round(CAST(sum(amt) AS DOUBLE), 6) AS "_OrderTotalAmount" FROM f""",
)
def by_type(spark, sf):
    return _rounded(evaluate(star(spark, sf), ["_OrderTotalAmount"], ["OrderType.OrderTypeName"]))


# ---- customers -----------------------------------------------------------------

CUSTOMERS = ["_CountRepeatCustomers", "_CountNewCustomers", "_CountCustomersWithOrders"]
FLAGS = """flags AS (SELECT c_custkey, c_mktsegment, CASE WHEN n > 1 THEN true WHEN n = 1 THEN false END AS flag
  FROM customer LEFT JOIN (SELECT "CustomerId", count(*) AS n FROM o GROUP BY 1) ON "CustomerId" = c_custkey)"""
COUNTS = """count(DISTINCT c_custkey) FILTER (WHERE flag) AS "_CountRepeatCustomers",
  count(DISTINCT c_custkey) FILTER (WHERE NOT coalesce(flag, false)) AS "_CountNewCustomers",
  count(DISTINCT c_custkey) FILTER (WHERE flag IS NOT NULL) AS "_CountCustomersWithOrders" """

@query("customers_repeat_new", f"WITH {STAR_SQL}, {FLAGS} SELECT {COUNTS} FROM flags")
def repeat_new(spark, sf):
    return evaluate(star(spark, sf), CUSTOMERS)


@query(
    "customers_repeat_new_by_segment",
    f"""WITH {STAR_SQL}, {FLAGS} SELECT c_mktsegment AS "Segment", {COUNTS} FROM flags GROUP BY c_mktsegment""",
)
def repeat_new_by_segment(spark, sf):
    return evaluate(star(spark, sf), CUSTOMERS, ["IndividualCustomer.Segment"])


@query(
    "customers_by_month",
    f"""WITH {STAR_SQL}, {FLAGS}, s AS (SELECT DISTINCT CAST(year(d) AS INTEGER) AS "Year",
      CAST(month(d) AS INTEGER) AS "MonthNo", "CustomerId" FROM o)
    SELECT "Year", "MonthNo", {COUNTS} FROM s JOIN flags ON c_custkey = "CustomerId" GROUP BY 1, 2""",
)
def customers_by_month(spark, sf):
    return evaluate(star(spark, sf), CUSTOMERS, ["Date.Year", "Date.MonthNo"])


@query(
    "customers_rollup",
    f"""WITH {STAR_SQL}, {FLAGS}, s AS (SELECT CAST(year(d) AS INTEGER) AS y, 'Qtr ' || quarter(d)::VARCHAR AS q,
      strftime(d, '%B') AS m, CAST(day(d) AS INTEGER) AS dd, c_custkey, flag FROM o JOIN flags ON c_custkey = "CustomerId"
      WHERE flag IS NOT NULL)
    SELECT y AS "Year", q AS "Quarter", m AS "Month", dd AS "Day", CAST(4 - grouping(y) - grouping(q) - grouping(m) - grouping(dd) AS INTEGER)
      AS level, {COUNTS} FROM s GROUP BY ROLLUP (y, q, m, dd)""",
)
def rolled_customers(spark, sf):
    """Distinct customers at all four levels and in all, from one bitmap a day."""
    return customers_rollup(star(spark, sf))


@query(
    "customer_flags",
    f"""WITH {STAR_SQL}, {FLAGS} SELECT c_custkey AS "CustomerId", flag AS "_HasMultipleOrders",
    CASE WHEN flag THEN 'Repeat customers' WHEN NOT flag THEN 'New customers' END AS "_RepeatOrNewCustomer" FROM flags""",
)
def customer_flags(spark, sf):
    s = star(spark, sf)
    flagged = add_repeatornewcustomer(add_hasmultipleorders(s["IndividualCustomer"], s["Order"]))
    return flagged.select("CustomerId", "_HasMultipleOrders", "_RepeatOrNewCustomer")


@query(
    "multiple_orders",
    f"""WITH {STAR_SQL} SELECT "CustomerId", count(DISTINCT "CustomerId") > 1 AS "Multiple Orders"
    FROM o GROUP BY "CustomerId" """,
)
def multiple_orders(spark, sf):
    return evaluate(star(spark, sf), ["Multiple Orders"], ["IndividualCustomer.CustomerId"])


@query(
    "multiple_orders_by_month",
    f"""WITH {STAR_SQL} SELECT CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "MonthNo",
      count(DISTINCT "CustomerId") > 1 AS "Multiple Orders" FROM o GROUP BY 1, 2""",
)
def multiple_by_month(spark, sf):
    return evaluate(star(spark, sf), ["Multiple Orders"], ["Date.Year", "Date.MonthNo"])


@query(
    "kpi_with_customers_by_segment",
    f"""WITH {STAR_SQL}, {FLAGS}, a AS (SELECT c_mktsegment AS "Segment", {COUNTS} FROM flags GROUP BY 1),
    b AS (SELECT c_mktsegment AS "Segment", round(CAST(sum(amt) AS DOUBLE), 6) AS "_OrderTotalAmount",
      count(DISTINCT "CustomerId") > 1 AS "Multiple Orders" FROM o JOIN customer ON c_custkey = "CustomerId" GROUP BY 1)
    SELECT a.*, "_OrderTotalAmount", "Multiple Orders" FROM a JOIN b ON a."Segment" = b."Segment" """,
)
def mixed(spark, sf):
    measures = ["_OrderTotalAmount", *CUSTOMERS, "Multiple Orders"]
    return _rounded(evaluate(star(spark, sf), measures, ["IndividualCustomer.Segment"]))


@query(
    "order_booked_date",
    """SELECT o_orderkey AS "OrderId", CAST(o_orderdate AS DATE) AS "_OrderBookedDate" FROM orders""",
)
def booked(spark, sf):
    return add_orderbookeddate(star(spark, sf)["Order"]).select("OrderId", "_OrderBookedDate")


@query(
    "status_for_sales_revenue",
    f"""WITH {STAR_SQL}, t AS (SELECT * FROM (VALUES (0, 'Unsubmitted'), (1, 'AwaitingApproval'), (2, 'Declined'), (3, 'Open'),
      (4, 'Completed'), (5, 'Canceled')) v(id, name))
    SELECT name AS "OrderStatusTypeName", CASE WHEN name IN ('Completed', 'Open') THEN 'Completed'
      WHEN name = 'Canceled' THEN 'Returned/Canceled' END AS "_OrderStatusForSalesRevenue", count("OrderId") AS orders
    FROM t LEFT JOIN o ON status = id GROUP BY 1, 2""",
)
def sales_status(spark, sf):
    """The seeded statuses with the number of orders in each."""
    s = star(spark, sf)
    orders = s["OrderStatus"].groupBy("OrderStatusTypeId").agg(F.count(F.lit(1)).alias("orders"))
    rows = add_orderstatusforsalesrevenue(s["OrderStatusType"]).join(orders, "OrderStatusTypeId", "left")
    return rows.select(
        "OrderStatusTypeName", "_OrderStatusForSalesRevenue", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders")
    )
