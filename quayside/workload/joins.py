"""Lookups, semi and outer joins, and joins along relationships."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators.calendar import date_dimension, join_on_day
from quayside.operators.lookup import lookup_any, outer_using, semi
from quayside.operators.star import Relationship, count_related, propagate_all, propagate_filter, related, related_one
from quayside.plans.model import RELATIONSHIPS, relationship
from quayside.workload import query
from quayside.workload.inputs import load, star
from quayside.workload.nested import PRODUCTS_SQL, products, variants


@query(
    "country_lookup_or",
    """WITH c AS (SELECT n_nationkey AS id, 'N' || n_nationkey::VARCHAR AS iso2, n_name AS iso3 FROM nation),
    a AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'zz' WHEN c_mktsegment = 'BUILDING' THEN 'n' || c_nationkey::VARCHAR
                            ELSE 'nation_' || c_nationkey::VARCHAR END AS country FROM customer)
    SELECT c_custkey, country, id AS country_id FROM a LEFT JOIN c ON upper(country) = iso2 OR upper(country) = iso3""",
)
def country_lookup(spark, sf):
    """Countries written as a short code by some customers, as a long one by others, and wrongly by the rest."""
    text = F.col("c_nationkey").cast("string")
    country = (
        F.when(F.col("c_acctbal") < 0, "zz")
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("n"), text))
        .otherwise(F.concat(F.lit("nation_"), text))
    )
    customers = load(spark, sf, "customer").select("c_custkey", country.alias("country"))
    countries = load(spark, sf, "nation").select(
        F.col("n_nationkey").alias("country_id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso2"),
        F.col("n_name").alias("iso3"),
    )
    return lookup_any(customers, countries, "country", ["iso2", "iso3"], ["country_id"])


@query(
    "semi_changed_parents",
    """SELECT o_orderkey, o_orderstatus FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def semi_parents(spark, sf):
    returned = load(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return semi(load(spark, sf, "orders"), returned, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_orderstatus")


@query(
    "outer_variants",
    f"""WITH {PRODUCTS_SQL} SELECT prod.id AS product, variant, name FROM var FULL JOIN
    (SELECT id, name AS n, has_specs FROM prod) prod ON prod.id = var.id""",
)
def outer_variants(spark, sf):
    """Variants joined to all products: products without a variant keep a row, with no name of a variant."""
    made = variants(spark, sf).where(F.col("ProductID").isNotNull())
    made = made.select("ExternalProductID", F.col("ProductID").alias("variant"), F.col("Name").alias("name"))
    base = products(spark, sf).select("ExternalProductID", F.size("Specs").alias("n"))
    return outer_using(made, base, ["ExternalProductID"]).select(
        F.col("ExternalProductID").alias("product"), "variant", "name"
    )


@query(
    "outer_null_keys",
    """WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation FROM customer),
    b AS (SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_nationkey + 20 END AS nation FROM supplier),
    bb AS (SELECT nation, min(s_suppkey) AS s_suppkey FROM b WHERE nation IS NOT NULL GROUP BY nation
           UNION ALL SELECT NULL, s_suppkey FROM b WHERE nation IS NULL)
    SELECT coalesce(a.nation, bb.nation) AS nation, c_custkey, s_suppkey FROM a FULL JOIN bb ON a.nation = bb.nation""",
)
def outer_null_keys(spark, sf):
    def balance(column, key):
        return F.when(F.col(column) >= 0, F.col(key))

    a = load(spark, sf, "customer").select("c_custkey", balance("c_acctbal", "c_nationkey").alias("nation"))
    b = load(spark, sf, "supplier").select(
        "s_suppkey", balance("s_acctbal", "s_nationkey").alias("nation")
    ).withColumn("nation", F.col("nation") + 20)
    known = b.where(F.col("nation").isNotNull()).groupBy("nation").agg(F.min("s_suppkey").alias("s_suppkey"))
    unknown = b.where(F.col("nation").isNull()).select("nation", "s_suppkey")
    return outer_using(a, known.unionByName(unknown), ["nation"])


@query(
    "related_lookup",
    """SELECT o_orderkey AS "OrderId", c_name AS "IndividualCustomerName", c_mktsegment AS "Segment" FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey""",
)
def related_lookup(spark, sf):
    s = star(spark, sf)
    rows = related(
        s["Order"], s["IndividualCustomer"], relationship("Order", "IndividualCustomer"),
        ["IndividualCustomerName", "Segment"],
    )
    return rows.select("OrderId", "IndividualCustomerName", "Segment")


@query(
    "related_one_to_one",
    """SELECT o_orderkey AS "OrderId", CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 ELSE 1 END::BIGINT
    AS "OrderStatusTypeId", o_custkey AS "CustomerId" FROM orders""",
)
def one_to_one(spark, sf):
    s = star(spark, sf)
    rows = related_one(s["OrderStatus"], s["Order"], relationship("OrderStatus", "Order"))
    return rows.select("OrderId", "OrderStatusTypeId", "CustomerId")


LINE_STATUS = Relationship("OrderLine", "OrderId", "OrderLineStatus", "OrderId", active=False)


@query(
    "related_inactive",
    """SELECT l_orderkey AS "OrderId", l_partkey AS "ProductId",
       CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 WHEN 'P' THEN 1 END::BIGINT AS "OrderStatusTypeId"
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
)
def inactive(spark, sf):
    s = star(spark, sf)
    rows = related(s["OrderLine"], s["OrderStatus"], LINE_STATUS, ["OrderStatusTypeId"], use_inactive=True)
    return rows.select("OrderId", "ProductId", "OrderStatusTypeId")


@query(
    "blank_member",
    """SELECT p_type AS category, count(*) AS lines FROM lineitem
    LEFT JOIN part ON l_partkey = CASE WHEN p_brand = 'Brand#1' THEN -1 - p_partkey ELSE p_partkey END GROUP BY p_type""",
)
def blank_member(spark, sf):
    """Lines whose product is not in the dimension count under a blank category."""
    s = star(spark, sf)
    # products of one brand go by a key that no line has
    key = F.when(F.col("p_brand") == "Brand#1", -1 - F.col("p_partkey")).otherwise(F.col("p_partkey"))
    known = load(spark, sf, "part").select(key.alias("ProductId"), F.col("p_type").alias("category"))
    rows = related(s["OrderLine"], known, relationship("OrderLine", "RetailProduct"), ["category"])
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "propagate_filter",
    """SELECT o_orderkey AS "OrderId" FROM orders WHERE EXISTS
    (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""",
)
def filter_down(spark, sf):
    s = star(spark, sf)
    picked = s["IndividualCustomer"].where(F.col("Segment") == "BUILDING")
    return propagate_filter(picked, s["Order"], relationship("Order", "IndividualCustomer")).select("OrderId")


@query(
    "propagate_filter_both",
    """SELECT c_custkey AS "CustomerId", c_mktsegment AS "Segment" FROM customer WHERE EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def filter_both(spark, sf):
    s = star(spark, sf)
    large = s["Order"].where(F.col("OrderTotalAmount") > 400000)
    rel = relationship("Order", "IndividualCustomer")
    _, customers = propagate_filter(s["IndividualCustomer"], large, rel, both=True)
    return customers.select("CustomerId", "Segment")


REACHED = """WITH line AS (SELECT row_number() OVER () AS rid, * FROM lineitem),
  ok_customer AS (SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey
    AND n_name IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5'))),
  ok_order AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'
    AND EXISTS (SELECT 1 FROM ok_customer WHERE c_custkey = o_custkey))"""


@query(
    "propagate_all",
    f"""{REACHED}
    SELECT 'Order' AS "table", o_orderkey::VARCHAR AS key FROM ok_order
    UNION ALL SELECT 'IndividualCustomer', c_custkey::VARCHAR FROM ok_customer
      WHERE EXISTS (SELECT 1 FROM ok_order WHERE o_custkey = c_custkey)
    UNION ALL SELECT 'OrderLine', l_orderkey::VARCHAR || '-' || l_partkey::VARCHAR FROM line
      WHERE EXISTS (SELECT 1 FROM ok_order WHERE o_orderkey = l_orderkey)
    UNION ALL SELECT 'OrderStatus', o_orderkey::VARCHAR FROM ok_order
    UNION ALL SELECT 'OrderStatusType', v FROM (VALUES ('Completed')) t(v)
    UNION ALL SELECT 'Location', c_custkey::VARCHAR FROM ok_customer WHERE EXISTS (SELECT 1 FROM ok_order WHERE o_custkey = c_custkey)
    UNION ALL SELECT 'Country', n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')
    UNION ALL SELECT 'CustomerGroup', c_mktsegment FROM customer JOIN ok_order ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def filter_all(spark, sf):
    """Filters on countries, order status and orders, and what each of eight tables keeps. Countries and status types are
    only filtered by their own filter, since their edges lead one way."""
    s = star(spark, sf)
    filters = {
        "Country": F.col("IsoCountryName").isin([f"NATION_{i}" for i in range(1, 6)]),
        "OrderStatusType": F.col("OrderStatusTypeName") == "Completed",
        "Order": F.col("OrderTotalAmount") > 100000,
    }
    keys = {
        "Order": F.col("OrderId").cast("string"),
        "IndividualCustomer": F.col("CustomerId").cast("string"),
        "OrderLine": F.concat_ws("-", "OrderId", "ProductId"),
        "OrderStatus": F.col("OrderId").cast("string"),
        "OrderStatusType": F.col("OrderStatusTypeName"),
        "Location": F.col("LocationId").cast("string"),
        "Country": F.col("IsoCountryName"),
        "CustomerGroup": F.col("CustomerGroupId"),
    }
    result = None
    for name, df in propagate_all(s, RELATIONSHIPS, filters, list(keys)).items():
        part = df.select(F.lit(name).alias("table"), keys[name].alias("key"))
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "count_related",
    """SELECT c_custkey AS "CustomerId", CAST(nullif(count(o_orderkey), 0) AS BIGINT) AS orders FROM customer
    LEFT JOIN orders ON c_custkey = CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -1 - o_custkey END GROUP BY c_custkey""",
)
def related_count(spark, sf):
    s = star(spark, sf)
    # orders that are not urgent go by a key that no customer has
    key = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).otherwise(-1 - F.col("o_custkey"))
    urgent = load(spark, sf, "orders").select(key.alias("o_custkey"))
    rows = count_related(s["IndividualCustomer"], urgent, "CustomerId", "o_custkey", "orders")
    return rows.select("CustomerId", "orders")


@query(
    "join_on_day",
    """SELECT event_id, CAST(ts AS DATE) AS "Date", CAST(year(ts) AS INTEGER) AS "Year",
       strftime(ts, '%B') AS "Month" FROM events""",
)
def day_join(spark, sf):
    events = load(spark, sf, "events")
    days = date_dimension(events, "ts")
    return join_on_day(events, "ts", days, ["Date", "Year", "Month"]).select("event_id", "Date", "Year", "Month")
