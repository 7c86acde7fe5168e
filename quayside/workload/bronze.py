"""The given tables in the shape of bronze events, for the entity jobs.

An order document carries its own lines, so its array is as long as one order;
everything else is a projection of one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.sources.changes import CHANGE_TYPE, COMMIT_VERSION, INSERT
from quayside.workload.inputs import load

EVENT_AT = "2024-01-01T00:00:00Z"


def text(name: str) -> Column:
    return F.col(name).cast("string")


def event_times() -> list[Column]:
    return [F.lit(EVENT_AT).cast("timestamp").alias(c) for c in ("EventProcessedUtcTime", "EventEnqueuedUtcTime")]


def envelope(df: DataFrame, verb: Column, **columns: Column) -> DataFrame:
    """A commit of API calls: the given columns plus verb, date, event time and change columns."""
    return df.select(
        *[c.alias(name) for name, c in columns.items()],
        verb.alias("Verb"),
        F.lit(EVENT_AT).alias("Date"),
        *event_times(),
        F.lit(1).cast("bigint").alias(COMMIT_VERSION),
        F.lit(INSERT).alias(CHANGE_TYPE),
    )


def struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def body(**fields: Column) -> Column:
    return struct(Body=struct(**fields))


def verb_of(balance: str) -> Column:
    """Customers and suppliers in debt are removed, the others written."""
    return F.when(F.col(balance) < 0, "DELETE").otherwise("PUT")


def users(spark, sf) -> DataFrame:
    """Customers as user events. Those in debt arrive as deletions that name the id only in the route."""
    rows = load(spark, sf, "customer")
    alive = F.col("c_acctbal") >= 0
    phone = F.concat(F.lit("+1 "), text("c_nationkey"), F.lit(" "), text("c_custkey"))
    return envelope(
        rows,
        verb_of("c_acctbal"),
        RouteParams=struct(buyerID=F.lit("b"), userID=text("c_custkey")),
        Response=body(
            ID=F.when(alive, text("c_custkey")),
            FirstName=F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")),
            LastName=F.col("c_name"),
            Email=F.concat(F.lower("c_name"), F.lit("@example.com")),
            Phone=phone,
        ),
    )


def addresses(spark, sf) -> DataFrame:
    rows = load(spark, sf, "supplier")
    return envelope(
        rows,
        verb_of("s_acctbal"),
        RouteParams=struct(buyerID=F.lit("b"), addressID=text("s_suppkey")),
        Response=body(
            ID=F.when(F.col("s_acctbal") >= 0, text("s_suppkey")),
            FirstName=F.col("s_name"),
            LastName=F.lit(None).cast("string"),
            Street1=F.concat(text("s_suppkey"), F.lit(" Main Street")),
            Street2=F.lit(None).cast("string"),
            City=F.concat(F.lit("City "), text("s_nationkey")),
            Zip=text("s_nationkey"),
            Country=F.concat(F.lit("n"), text("s_nationkey")),
        ),
    )


def address_assignments(spark, sf) -> DataFrame:
    """Customers assigned to a supplier's place; calls for customers in debt failed."""
    rows = load(spark, sf, "customer")
    error = struct(ErrorCode=F.lit("e"), Message=F.lit("debt"))
    return envelope(
        rows,
        F.lit("POST"),
        RouteParams=struct(buyerID=F.lit("b"), addressID=text("c_nationkey")),
        QueryParams=struct(userID=text("c_custkey"), userGroupID=F.lit(None).cast("string")),
        Request=body(UserID=F.lit(None).cast("string"), AddressID=text("c_nationkey")),
        Response=body(Errors=F.when(F.col("c_acctbal") < 0, F.array(error))),
    )


def named(spark, sf, table: str, key: str, name: str, description: Column, verb: Column, route: str) -> DataFrame:
    return envelope(
        load(spark, sf, table),
        verb,
        RouteParams=struct(**{route: text(key)}),
        Response=body(ID=text(key), Name=F.col(name), Description=description),
    )


def memberships(spark, sf) -> DataFrame:
    """Customers in the group of their segment; those in debt leave it."""
    rows = load(spark, sf, "customer")
    return envelope(
        rows,
        verb_of("c_acctbal"),
        RouteParams=struct(buyerID=F.lit("b"), userGroupID=F.col("c_mktsegment"), userID=text("c_custkey")),
        Request=body(UserGroupID=F.lit(None).cast("string"), UserID=F.lit(None).cast("string")),
        Response=body(Errors=F.lit(None).cast("array<string>")),
    )


def orders(spark, sf) -> DataFrame:
    columns = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct(*columns).alias("line"))
    lines = lines.groupBy("o_orderkey").agg(F.collect_list("line").alias("lines"))

    def line(l: Column) -> Column:  # noqa: E741
        return struct(
            ID=F.concat_ws("-", *[l[c].cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")]),
            Quantity=l["l_quantity"].cast("bigint"),
            UnitPrice=F.round(l["l_extendedprice"] / l["l_quantity"], 2),
            LineTotal=l["l_extendedprice"],
            Product=struct(ID=l["l_partkey"].cast("string")),
        )

    lines = lines.select("o_orderkey", F.transform("lines", line).alias("LineItems"))
    rows = load(spark, sf, "orders").join(lines, "o_orderkey", "left")
    status = F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "F", 4).otherwise(1)
    return rows.select(
        text("o_orderkey").alias("ID"),
        text("o_custkey").alias("FromUserID"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DateCreated"),
        F.col("o_totalprice").alias("Total"),
        F.coalesce(F.size("LineItems"), F.lit(0)).cast("bigint").alias("LineItemCount"),
        status.cast("bigint").alias("Status"),
        "LineItems",
        *event_times(),
        F.lit(1).cast("bigint").alias(COMMIT_VERSION),
        F.lit(INSERT).alias(CHANGE_TYPE),
    )


def products(spark, sf) -> DataFrame:
    from quayside.workload.nested import products as documents

    rows = documents(spark, sf, "p_partkey", "p_type", "p_size", "p_brand")
    return rows.select(
        text("p_partkey").alias("ProductID"),
        "Name",
        F.col("p_brand").alias("Description"),
        (F.col("p_size") > 25).alias("Returnable"),
        F.array("p_brand").alias("Catalogs"),
        F.array(struct(ID=F.col("p_type"))).alias("Categories"),
        "Specs",
        *event_times(),
        F.lit(1).cast("bigint").alias(COMMIT_VERSION),
        F.lit(INSERT).alias(CHANGE_TYPE),
    )
