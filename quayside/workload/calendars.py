"""Calendars, drill-down and shifted periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.numbers import money
from quayside.operators.calendar import (
    calendar,
    calendar_between,
    calendar_parts,
    date_dimension,
    date_range,
    join_on_day,
    ordered_labels,
)
from quayside.operators.summarise import Agg, drill, drill_rollup
from quayside.plans.measures import date_range_label, days_in_range, shift_period
from quayside.workload import query
from quayside.workload.inputs import load

PARTS = """CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "MonthNo", strftime(d, '%B') AS "Month",
  CAST(quarter(d) AS INTEGER) AS "QuarterNo", 'Qtr ' || quarter(d)::VARCHAR AS "Quarter", CAST(day(d) AS INTEGER) AS "Day" """
DAYS = """days AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
  INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""


@query("calendar", f"""WITH {DAYS} SELECT d AS "Date" FROM days""")
def order_calendar(spark, sf):
    return calendar(load(spark, sf, "orders"), "o_orderdate")


@query(
    "date_dimension",
    f"""WITH b AS (SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS lo,
                 make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS hi FROM orders),
    days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
    SELECT d AS "Date", {PARTS} FROM days""",
)
def order_dates(spark, sf):
    return date_dimension(load(spark, sf, "orders"), "o_orderdate")


@query(
    "calendar_template",
    """SELECT CAST(ts AS DATE) AS "Date", CAST(day(ts) AS INTEGER) AS "Day", count(*) AS events FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-12-31' GROUP BY 1, 2""",
)
def template(spark, sf):
    """A calendar of fixed days, holding the events that fall on it."""
    days = calendar_between(spark, "2024-01-01", "2024-12-31")
    rows = join_on_day(load(spark, sf, "events"), "ts", days, ["Date", "Day"])
    return rows.where(F.col("Date").isNotNull()).groupBy("Date", "Day").agg(F.count(F.lit(1)).alias("events"))


AGGS = {"orders": Agg("count", "o_orderkey"), "total": Agg("sum", "amount"), "mean": Agg("avg", "amount")}
TOTALS = """CAST(count(o_orderkey) AS BIGINT) AS orders, CAST(sum(amount) AS DOUBLE) AS total,
  CAST(sum(amount) AS DOUBLE) / count(amount) AS mean"""
AMOUNTS = f"""a AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS d FROM orders),
  p AS (SELECT *, {PARTS} FROM a)"""
LEVELS = ["Year", "Quarter", "Month", "Day"]


def _orders(spark, sf):
    return load(spark, sf, "orders").withColumn("amount", money("o_totalprice"))


def _double(df):
    return df.withColumn("total", F.col("total").cast("double"))


def _register(level: str) -> None:
    names = ", ".join(f'"{c}"' for c in LEVELS[: LEVELS.index(level) + 1])

    @query(f"drill_{level.lower()}", f"WITH {AMOUNTS} SELECT {names}, {TOTALS} FROM p GROUP BY {names}")
    def run(spark, sf):
        return _double(drill(_orders(spark, sf), "o_orderdate", level, AGGS))


for _level in LEVELS:
    _register(_level)


@query(
    "drill_rollup",
    f"""WITH {AMOUNTS} SELECT "Year", "Quarter", "Month", "Day", {TOTALS} FROM p
    GROUP BY ROLLUP ("Year", "Quarter", "Month", "Day")""",
)
def rolled(spark, sf):
    return _double(drill_rollup(_orders(spark, sf), "o_orderdate", AGGS))


@query(
    "order_label_by",
    """SELECT name AS "Month", CAST(row_number() OVER (ORDER BY no) AS INTEGER) AS place FROM
    (SELECT DISTINCT strftime(o_orderdate, '%B') AS name, month(o_orderdate) AS no FROM orders)""",
)
def labels_in_order(spark, sf):
    """Month names in calendar order, with the place each gets in a report (twelve labels at most)."""
    days = calendar_parts(load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("Date")))
    labels = ordered_labels(days, "Month")
    return labels.select(F.posexplode("labels").alias("place", "Month")).select("Month", (F.col("place") + 1).alias("place"))


@query(
    "date_range_label",
    """SELECT strftime(min(o_orderdate), '%-m/%-d/%Y') || ' - ' || strftime(max(o_orderdate), '%-m/%-d/%Y') AS label,
    CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1 AS INTEGER) AS days FROM orders""",
)
def range_label(spark, sf):
    return date_range(load(spark, sf, "orders"), "o_orderdate").select(
        date_range_label("lo", "hi").alias("label"), days_in_range("lo", "hi").alias("days")
    )


@query(
    "shift_period",
    f"""WITH {DAYS} SELECT a.d AS "Date", b.d AS shifted FROM days a JOIN days b ON b.d = a.d - 365""",
)
def shifted(spark, sf):
    days = calendar(load(spark, sf, "orders"), "o_orderdate")
    return shift_period(days, 365, days, "shifted")
