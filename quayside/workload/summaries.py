"""Aggregations, default summaries, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.numbers import money
from quayside.operators.nested import with_row_id
from quayside.operators.summarise import (
    avg_of,
    calculate,
    count_of,
    count_rows,
    default_aggs,
    distinct_count,
    distinct_counts,
    sum_of,
    summarize,
)
from quayside.plans.measures import summaries
from quayside.sources.tables import preview
from quayside.workload import query
from quayside.workload.inputs import STAR_SQL, load, star


@query(
    "summarize_basic",
    """WITH a AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS t FROM orders)
    SELECT o_orderpriority, CAST(sum(t) AS DOUBLE) AS total, round(avg(o_totalprice), 4) AS mean, min(o_orderdate) AS first,
       max(o_orderdate) AS last, count(o_custkey) AS customers, CAST(nullif(count(*), 0) AS BIGINT) AS rows FROM a
    GROUP BY o_orderpriority""",
)
def basic(spark, sf):
    return summarize(
        load(spark, sf, "orders"),
        ["o_orderpriority"],
        {
            "total": sum_of(money("o_totalprice")).cast("double"),
            "mean": F.round(avg_of("o_totalprice"), 4),
            "first": F.min("o_orderdate"),
            "last": F.max("o_orderdate"),
            "customers": count_of("o_custkey"),
            "rows": count_rows(),
        },
    )


@query(
    "distinct_count_blank",
    """WITH c AS (SELECT c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS n FROM customer)
    SELECT c_mktsegment, count(DISTINCT n) + max(CASE WHEN n IS NULL THEN 1 ELSE 0 END) AS nations FROM c GROUP BY c_mktsegment""",
)
def distinct_blank(spark, sf):
    rows = load(spark, sf, "customer").withColumn("n", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")))
    return rows.groupBy("c_mktsegment").agg(distinct_count("n").alias("nations"))


@query(
    "distinct_counts",
    """SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus""",
)
def two_step_distinct(spark, sf):
    return distinct_counts(load(spark, sf, "orders"), ["o_orderstatus"], "o_custkey", "customers")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query(
    "calculate_filtered",
    """WITH a AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS t FROM orders)
    SELECT o_orderpriority, CAST(sum(t) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS completed,
       count(o_orderkey) FILTER (WHERE o_orderstatus = 'O' AND o_totalprice > 100000) AS large_open FROM a
    GROUP BY o_orderpriority""",
)
def filtered(spark, sf):
    status = F.col("o_orderstatus")
    return load(spark, sf, "orders").groupBy("o_orderpriority").agg(
        calculate("sum", money("o_totalprice"), status == "F").cast("double").alias("completed"),
        calculate("count", "o_orderkey", status == "O", F.col("o_totalprice") > 100000).alias("large_open"),
    )


@query(
    "default_summaries",
    f"""WITH {STAR_SQL} SELECT 'Order' AS "table", 'OrderTotalAmount' AS "column", CAST(sum(amt) AS DOUBLE) AS value FROM o
    UNION ALL SELECT 'Order', 'NumberOfOrderLines', CAST(sum(lines) AS DOUBLE) FROM o
    UNION ALL SELECT 'OrderLine', 'ProductSalesPriceAmount',
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem
    UNION ALL SELECT 'OrderLine', 'Quantity', CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem
    UNION ALL SELECT 'OrderLine', 'TotalOrderLineAmount',
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem
    UNION ALL SELECT 'OrderLineStatus', 'OrderLineStatusTypeId', CAST(count(l_linestatus) AS DOUBLE) FROM lineitem
    UNION ALL SELECT 'Shipment', 'ShipmentFromLocationId', CAST(count(s_nationkey) AS DOUBLE) FROM supplier
    UNION ALL SELECT 'Shipment', 'OriginationWarehouseId', CAST(count(s_suppkey) AS DOUBLE) FROM supplier
    UNION ALL SELECT 'CustomerTelephoneNumber', 'TelephoneNumber', CAST(sum(c_custkey) AS DOUBLE) FROM customer""",
)
def defaults(spark, sf):
    lines = load(spark, sf, "lineitem")
    tables = {
        "Order": star(spark, sf, lines=True)["Order"].withColumn("OrderTotalAmount", money("OrderTotalAmount")),
        "OrderLine": lines.select(
            money("l_extendedprice").alias("ProductSalesPriceAmount"),
            money("l_quantity").alias("Quantity"),
            money("l_extendedprice").alias("TotalOrderLineAmount"),
        ),
        "OrderLineStatus": lines.select(F.col("l_linestatus").alias("OrderLineStatusTypeId")),
        "Shipment": load(spark, sf, "supplier").select(
            F.col("s_nationkey").alias("ShipmentFromLocationId"), F.col("s_suppkey").alias("OriginationWarehouseId")
        ),
        "CustomerTelephoneNumber": load(spark, sf, "customer").select(F.col("c_custkey").alias("TelephoneNumber")),
    }
    result = None
    for name, df in tables.items():
        aggs = default_aggs(name)
        row = df.agg(*[agg.cast("double").alias(c) for c, agg in aggs.items()])
        part = row.unpivot([], list(aggs), "column", "value").withColumn("table", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "summaries_by_category",
    f"""WITH {STAR_SQL}, a AS (SELECT CAST(sum(amt) AS DOUBLE) AS amount, CAST(sum(lines) AS BIGINT) AS lines FROM o),
    q AS (SELECT p_type AS "ProductCategoryName", CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS "Quantity",
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "TotalOrderLineAmount"
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY p_type)
    SELECT q.*, amount AS "OrderTotalAmount", lines AS "NumberOfOrderLines" FROM q, a""",
)
def by_category(spark, sf):
    """Quantities of lines by product type, beside order amounts, which no product filters and so repeat in every row."""
    columns = ["OrderLine.Quantity", "OrderLine.TotalOrderLineAmount", "Order.OrderTotalAmount", "Order.NumberOfOrderLines"]
    return _as_doubles(summaries(star(spark, sf, lines=True), columns, ["ProductCategory.ProductCategoryName"]))


@query(
    "summaries_by_segment_and_year",
    f"""WITH {STAR_SQL}, a AS (SELECT c_mktsegment AS s, CAST(year(d) AS INTEGER) AS y, CAST(sum(amt) AS DOUBLE) AS amount
      FROM o JOIN customer ON c_custkey = "CustomerId" GROUP BY 1, 2),
    q AS (SELECT c_mktsegment AS s, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)
      AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
      JOIN part ON p_partkey = l_partkey AND p_type <> 'PROMO' GROUP BY 1, 2)
    SELECT coalesce(a.s, q.s) AS "Segment", coalesce(a.y, q.y) AS "Year", amount AS "OrderTotalAmount", quantity AS "Quantity"
    FROM a FULL JOIN q ON a.s = q.s AND a.y = q.y""",
)
def by_segment_and_year(spark, sf):
    """Two facts over shared dimensions. The filter on product types reaches lines only."""
    s = star(spark, sf)
    types = [r.p_type for r in load(spark, sf, "part").select("p_type").distinct().where("p_type <> 'PROMO'").collect()]
    by = ["IndividualCustomer.Segment", "Date.Year"]
    where = {"ProductCategory.ProductCategoryName": types}
    return _as_doubles(summaries(s, ["Order.OrderTotalAmount", "OrderLine.Quantity"], by, where))


def _as_doubles(df):
    return df.select([F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


@query("sorted_rows", "SELECT p_partkey, p_brand, p_name FROM part ORDER BY p_brand, p_name")
def sorted_rows(spark, sf):
    return load(spark, sf, "part").select("p_partkey", "p_brand", "p_name").orderBy("p_brand", "p_name")


@query(
    "preview_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000",
)
def preview_rows(spark, sf):
    """The thousand largest orders: a sort below a limit keeps a bounded heap per task."""
    ranked = load(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return preview(ranked.select("o_orderkey", "o_totalprice"))


@query("row_ids", "SELECT count(*) AS rows, count(*) AS ids FROM lineitem")
def row_ids(spark, sf):
    rows = with_row_id(load(spark, sf, "lineitem").select("l_orderkey")).select("id").distinct()
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("ids"))
