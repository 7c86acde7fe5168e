"""Scalar functions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import quayside.functions as q
from quayside.operators.nested import parse_event
from quayside.plans.entities import PERIOD_END, PERIOD_START, instant
from quayside.plans.model import STATUS_FOR_SALES_REVENUE
from quayside.workload import query
from quayside.workload.inputs import load

STATUS_SQL = "CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Completed' ELSE 'AwaitingApproval' END"


def _status():
    return q.switch_map("o_orderstatus", {"O": "Open", "F": "Completed"}, "AwaitingApproval")


@query(
    "text_functions",
    """SELECT c_custkey, c_mktsegment || ' ' || c_name AS full_name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name || '-' || c_mktsegment END AS strict_concat,
       concat_ws('-', c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END) AS skipping_concat,
       coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, '') || '|' || c_nationkey::VARCHAR AS blank_concat,
       upper(c_name) AS upper_name, contains(c_name, c_nationkey::VARCHAR) AS has_nation,
       array_to_string(list_distinct([c_mktsegment]), '.') AS joined FROM customer""",
)
def text_functions(spark, sf):
    shown = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return load(spark, sf, "customer").select(
        "c_custkey",
        q.full_name("c_mktsegment", "c_name").alias("full_name"),
        q.concat("c_name", F.lit("-"), shown).alias("strict_concat"),
        q.concat_ws("-", "c_name", shown).alias("skipping_concat"),
        q.text_concat(shown, F.lit("|"), "c_nationkey").alias("blank_concat"),
        q.upper("c_name").alias("upper_name"),
        q.contains("c_name", F.col("c_nationkey").cast("string")).alias("has_nation"),
        F.array_join(F.array_distinct(F.array("c_mktsegment", "c_mktsegment")), ".").alias("joined"),
    )


PHONE_SQL = """CASE c_mktsegment WHEN 'BUILDING' THEN '555-' || c_custkey::VARCHAR
  ELSE '+' || c_nationkey::VARCHAR || ' 41555 ' || c_custkey::VARCHAR END"""


@query(
    "normalize_phone",
    f"""WITH p AS (SELECT c_custkey, regexp_replace(regexp_replace({PHONE_SQL}, '\\s+', '', 'g'), '\\+', '00', 'g') AS clean
         FROM customer)
    SELECT c_custkey, clean, CAST(TRY_CAST(clean AS DECIMAL(10,0)) AS BIGINT) AS phone FROM p""",
)
def phone(spark, sf):
    raw = F.when(
        F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("555-"), F.col("c_custkey").cast("string"))
    ).otherwise(F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit(" 41555 "), F.col("c_custkey").cast("string")))
    return load(spark, sf, "customer").select(
        "c_custkey", q.clean_phone(raw).alias("clean"), q.normalize_phone(raw).cast("bigint").alias("phone")
    )


@query(
    "casts",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10,0)) AS BIGINT) AS whole,
       TRY_CAST(o_orderpriority AS BIGINT) AS no_number, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS digit,
       TRY_CAST(o_orderpriority AS TIMESTAMP) AS no_time,
       strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS parsed,
       TRY_CAST(o_orderstatus AS DOUBLE) AS lenient FROM orders""",
)
def casts(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        q.to_decimal("o_totalprice").cast("bigint").alias("whole"),
        q.to_long("o_orderpriority").alias("no_number"),
        q.to_int(F.substring("o_orderpriority", 1, 1)).alias("digit"),
        q.to_ts("o_orderpriority").cast("timestamp_ntz").alias("no_time"),
        q.to_ts(F.date_format("o_orderdate", "yyyy-MM-dd")).cast("timestamp_ntz").alias("parsed"),
        q.error_to_null("o_orderstatus", "double").alias("lenient"),
    )


@query(
    "conditionals",
    f"""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Yes' ELSE 'No' END AS is_open, {STATUS_SQL} AS status,
       CASE {STATUS_SQL} WHEN 'Completed' THEN 'Completed' WHEN 'Open' THEN 'Completed' END AS sales_status,
       CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' ELSE 'small' END AS size,
       coalesce(n, 0) AS lines, n IS NULL AS no_lines, NOT coalesce(n > 3, false) AS few_lines,
       CAST(NULL AS VARCHAR) AS nothing, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS first_tag
    FROM orders LEFT JOIN n ON l_orderkey = o_orderkey""",
)
def conditionals(spark, sf):
    counts = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = load(spark, sf, "orders").join(counts, "o_orderkey", "left").withColumn("name", _status())
    tags = F.filter(F.array("o_orderstatus"), lambda s: s != "P")
    price = F.col("o_totalprice")
    return rows.select(
        "o_orderkey",
        q.yes_no(F.col("o_orderstatus") == "O").alias("is_open"),
        F.col("name").alias("status"),
        q.switch_map("name", STATUS_FOR_SALES_REVENUE).alias("sales_status"),
        q.switch_true([(price > 300000, "large"), (price > 100000, "medium")], "small").alias("size"),
        q.blank_to("n").cast("bigint").alias("lines"),
        q.is_blank("n").alias("no_lines"),
        q.not_blank_aware(F.col("n") > 3).alias("few_lines"),
        q.typed_null().alias("nothing"),
        F.get(q.null_if_empty(tags), F.lit(0)).alias("first_tag"),
    )


@query(
    "calendar_functions",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS booked, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d,
       strftime(o_orderdate, '%B') AS month_name, CAST((month(o_orderdate) + 2) // 3 AS INTEGER) AS quarter_no,
       'Qtr ' || quarter(o_orderdate)::VARCHAR AS quarter, strftime(o_orderdate, '%-m/%-d/%Y') AS short,
       CAST(last_day(o_orderdate - INTERVAL 2 MONTH) AS DATE) AS eom,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS to_end,
       o_orderdate <= now()::TIMESTAMP AS past FROM orders""",
)
def calendar_functions(spark, sf):
    d = "o_orderdate"
    return load(spark, sf, "orders").select(
        "o_orderkey",
        q.booked_date(d).alias("booked"),
        q.year(d).alias("y"),
        q.month(d).alias("m"),
        q.day(d).alias("d"),
        q.month_name(d).alias("month_name"),
        q.quarter_no(d).alias("quarter_no"),
        q.quarter_label(d).alias("quarter"),
        q.short_date(d).alias("short"),
        q.eomonth(d, -2).alias("eom"),
        q.days_between(q.booked_date(d), F.lit("2001-12-31").cast("date")).alias("to_end"),
        (F.col(d).cast("timestamp") <= q.now_utc()).alias("past"),
    )


@query(
    "number_functions",
    """WITH n AS (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v
               FROM lineitem GROUP BY l_orderkey),
    r AS (SELECT o_orderkey, o_totalprice AS t, v, n, round(o_totalprice / nullif(n, 0), 6) AS per_line,
                 (coalesce(v, 0.0) - o_totalprice) / nullif(o_totalprice, 0) AS g
          FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)
    SELECT o_orderkey, per_line, CAST(round(t, 0) AS BIGINT) AS whole, round(g, 6) AS growth,
       CASE WHEN g < 0 THEN '↘ ' || CAST(round(g * -100, 0) AS BIGINT)::VARCHAR || '%'
            WHEN g > 0 THEN '↗ ' || CAST(round(g * 100, 0) AS BIGINT)::VARCHAR || '%' END AS label,
       '$' || format('{:,}', CAST(round(t, 0) AS BIGINT)) AS shown,
       '($' || format('{:,}', CAST(round(t, 0) AS BIGINT)) || ')' AS shown_negative,
       upper((n > 3)::VARCHAR) AS flag FROM r""",
)
def number_functions(spark, sf):
    lines = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(q.money("l_extendedprice")).cast("double").alias("v")
    )
    rows = load(spark, sf, "orders").join(lines, "o_orderkey", "left").withColumn("g", q.growth("v", "o_totalprice"))
    return rows.select(
        "o_orderkey",
        F.round(q.safe_divide("o_totalprice", "n"), 6).alias("per_line"),
        q.round0("o_totalprice").alias("whole"),
        F.round("g", 6).alias("growth"),
        q.growth_label("g").alias("label"),
        q.format_currency("o_totalprice").alias("shown"),
        q.format_currency(-F.col("o_totalprice")).alias("shown_negative"),
        q.format_boolean(F.col("n") > 3).alias("flag"),
    )


@query("parse_event", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parse(spark, sf):
    events = load(spark, sf, "events").select("event_id", parse_event("props", "k int").alias("body"))
    return events.select("event_id", "body.k")


@query(
    "period_sentinels",
    """SELECT c_custkey, TIMESTAMP '2000-11-16 13:06:46.713' AS period_start,
       TIMESTAMP '2999-11-16 13:06:46.713' AS period_end FROM customer""",
)
def sentinels(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey",
        instant(PERIOD_START).cast("timestamp_ntz").alias("period_start"),
        instant(PERIOD_END).cast("timestamp_ntz").alias("period_end"),
    )


@query(
    "add_drop_rename",
    """SELECT s_suppkey AS supplier_id, s_name, s_acctbal * 2 AS doubled, 1 AS kind, CAST(NULL AS VARCHAR) AS note
    FROM supplier""",
)
def shape(spark, sf):
    return (
        load(spark, sf, "supplier")
        .withColumn("doubled", F.col("s_acctbal") * 2)
        .withColumn("kind", F.lit(1))
        .withColumn("note", q.typed_null())
        .withColumnRenamed("s_suppkey", "supplier_id")
        .drop("s_nationkey", "s_acctbal")
    )


@query(
    "filters",
    """SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' AND contains(o_orderpriority, left(o_orderpriority, 1))""",
)
def filters(spark, sf):
    priority = F.col("o_orderpriority")
    return (
        load(spark, sf, "orders")
        .where(F.col("o_orderstatus") != "P")
        .where(priority == "1-URGENT")
        .where(q.contains(priority, F.substring(priority, 1, 1)))
        .select("o_orderkey", "o_orderstatus")
    )
