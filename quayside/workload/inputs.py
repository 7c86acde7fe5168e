"""The given tables in the shapes the operators work on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import use_utc


_SCHEMAS: dict[str, T.StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once; later reads need no job for it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = use_utc(spark).read.parquet(path).schema
    return use_utc(spark).read.schema(_SCHEMAS[path]).parquet(path)


class Star(dict):
    """Tables built when first asked for, so a query plans only what it reads."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.makers[name]()
        return self[name]


# The events table as a change feed: users are the entities, every half day is one commit,
# and the number in the event's properties decides the kind of change.
FEED_SQL = """
feed AS (
  SELECT event_id, user_id, ts, value, props,
         CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'POST'
                         WHEN 'purchase' THEN 'POST' ELSE 'PATCH' END AS Verb,
         date_trunc('day', ts) AS EventProcessedUtcTime,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 2 + hour(ts) // 12 AS _commit_version,
         CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 10 THEN 'delete'
              WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 20 THEN 'update_preimage'
              WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 30 THEN 'update_postimage' ELSE 'insert' END AS _change_type
  FROM events)
"""


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    step = F.from_json("props", "k int")["k"]
    return load(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        "value",
        "props",
        F.when(kind == "error", "DELETE").when(kind.isin("signup", "purchase"), "POST").otherwise("PATCH").alias("Verb"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("EventProcessedUtcTime"),
        (F.datediff("ts", F.lit("2024-01-01")) * 2 + F.expr("hour(ts) div 12")).alias("_commit_version"),
        F.when(step < 10, "delete")
        .when(step < 20, "update_preimage")
        .when(step < 30, "update_postimage")
        .otherwise("insert")
        .alias("_change_type"),
    )


# Orders with their number of lines, customers and nations under the names of the star.
STAR_SQL = """
lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT o_orderkey AS OrderId, o_custkey AS CustomerId, 1 AS OrderTypeId, o_orderdate AS OrderBookedDate,
         CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, coalesce(n, 0) AS lines,
         CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 ELSE 1 END AS status
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)
"""


def star(spark: SparkSession, sf_dir: str, lines: bool = False) -> Star:
    """The star over the given tables: customers carry their segment, nations serve as countries.

    ``lines`` adds the number of lines per order, which reads the line table.
    """
    from quayside.plans.model import order_status_types, order_types

    def table(name: str, **columns: str | Column) -> DataFrame:
        picked = [(F.col(c) if isinstance(c, str) else c).alias(out) for out, c in columns.items()]
        return load(spark, sf_dir, name).select(*picked)

    def orders() -> DataFrame:
        rows = table(
            "orders",
            OrderId="o_orderkey",
            CustomerId="o_custkey",
            # depends on the row, so that a join on it stays a join
            OrderTypeId=F.when(F.col("o_orderkey").isNotNull(), 1).cast("bigint"),
            OrderBookedDate="o_orderdate",
            OrderTotalAmount="o_totalprice",
        )
        if not lines:
            return rows
        counts = table("lineitem", OrderId="l_orderkey").groupBy("OrderId").agg(F.count(F.lit(1)).alias("n"))
        count = F.coalesce("n", F.lit(0).cast("bigint"))
        return rows.join(counts, "OrderId", "left").withColumn("NumberOfOrderLines", count).drop("n")

    status = F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "F", 4).otherwise(1)
    return Star(
        {
            "Order": orders,
            "OrderStatus": lambda: table("orders", OrderId="o_orderkey", OrderStatusTypeId=status.cast("bigint")),
            "OrderStatusType": lambda: order_status_types(spark),
            "OrderType": lambda: order_types(spark),
            "OrderLine": lambda: table(
                "lineitem",
                OrderId="l_orderkey",
                ProductId="l_partkey",
                Quantity="l_quantity",
                TotalOrderLineAmount="l_extendedprice",
            ),
            "IndividualCustomer": lambda: table(
                "customer", CustomerId="c_custkey", IndividualCustomerName="c_name", Segment="c_mktsegment"
            ),
            "CustomerLocation": lambda: table("customer", CustomerId="c_custkey", LocationId="c_custkey"),
            "Location": lambda: table(
                "customer", LocationId="c_custkey", CountryId=F.col("c_nationkey").cast("bigint")
            ),
            "Country": lambda: table(
                "nation", CountryId=F.col("n_nationkey").cast("bigint"), IsoCountryName="n_name"
            ),
            "RetailProduct": lambda: table("part", ProductId="p_partkey", CategoryId="p_type"),
            "ProductCategory": lambda: table("part", ProductCategoryId="p_type", ProductCategoryName="p_type").distinct(),
            "CustomerGroup": lambda: table("customer", CustomerGroupId="c_mktsegment").distinct(),
            "CustomerGroupCustomer": lambda: table("customer", CustomerGroupId="c_mktsegment", CustomerId="c_custkey"),
        }
    )
