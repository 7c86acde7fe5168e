"""The merge family: the line table's order summary as target, orders as source, and its variations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.conditional import typed_null
from quayside.operators.merge import MergeSpec, apply_changes, mark, mark_and_sweep, merge_into, merge_many, src
from quayside.operators.snapshot import latest_snapshot, live_changes
from quayside.session import run_dir, stage
from quayside.workload import query
from quayside.workload.inputs import FEED_SQL, feed, load

SUMMARY = """summary AS (SELECT l_orderkey AS id, count(*) AS lines,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS status
  FROM lineitem GROUP BY l_orderkey)"""


def _summary(spark, sf):
    return load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"),
    ).withColumn("status", typed_null())


def _orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "merge_upsert",
    f"""WITH {SUMMARY} SELECT coalesce(id, o_orderkey) AS id, CASE WHEN id IS NULL THEN 0 ELSE lines END AS lines,
       coalesce(o_totalprice, amount) AS amount, coalesce(o_orderstatus, status) AS status
    FROM summary FULL JOIN orders ON o_orderkey = id""",
)
def upsert(spark, sf):
    return merge_into(
        _summary(spark, sf),
        _orders(spark, sf),
        {"id": "o_orderkey"},
        update={"amount": "o_totalprice", "status": "o_orderstatus"},
        insert={"id": "o_orderkey", "lines": F.lit(0), "amount": "o_totalprice", "status": "o_orderstatus"},
    )


@query(
    "merge_insert_subset",
    f"""WITH {SUMMARY} SELECT * FROM summary UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL FROM orders WHERE NOT EXISTS (SELECT 1 FROM summary WHERE id = o_orderkey)""",
)
def insert_subset(spark, sf):
    return merge_into(
        _summary(spark, sf), _orders(spark, sf), {"id": "o_orderkey"}, insert={"id": "o_orderkey"},
        on_ambiguous="assume_unique",
    )


YEARS = """booked AS (SELECT o_custkey AS customer, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS orders,
    CAST(NULL AS BIGINT) AS shipped FROM orders GROUP BY 1, 2),
  sent AS (SELECT o_custkey AS customer, CAST(year(l_shipdate) AS INTEGER) AS y, count(*) AS n
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)"""


@query(
    "merge_upsert_composite",
    f"""WITH {YEARS} SELECT coalesce(b.customer, s.customer) AS customer, coalesce(b.y, s.y) AS y, orders, n AS shipped
    FROM booked b FULL JOIN sent s ON s.customer = b.customer AND s.y = b.y""",
)
def composite(spark, sf):
    orders = load(spark, sf, "orders")
    booked = orders.groupBy(F.col("o_custkey").alias("customer"), F.year("o_orderdate").alias("y")).agg(
        F.count(F.lit(1)).alias("orders")
    ).withColumn("shipped", typed_null("bigint"))
    lines = load(spark, sf, "lineitem").join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    sent = lines.groupBy(F.col("o_custkey").alias("customer"), F.year("l_shipdate").alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return merge_into(
        booked, sent, ["customer", "y"], update={"shipped": "n"}, insert={"customer": "customer", "y": "y", "shipped": "n"}
    )


@query(
    "merge_mark",
    f"""WITH {SUMMARY} SELECT id, lines, amount, CASE WHEN EXISTS (SELECT 1 FROM orders
    WHERE o_orderkey = id AND o_orderstatus = 'F') THEN 'delete-mark' ELSE status END AS status FROM summary""",
)
def marked(spark, sf):
    done = _orders(spark, sf).where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    return mark(_summary(spark, sf), done, "id", "status", "delete-mark")


@query(
    "merge_delete",
    f"""WITH {SUMMARY} SELECT * FROM summary WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_orderkey = id AND o_orderstatus = 'P')""",
)
def delete(spark, sf):
    pending = _orders(spark, sf).where(F.col("o_orderstatus") == "P")
    return merge_into(_summary(spark, sf), pending, {"id": "o_orderkey"}, delete=True)


@query(
    "merge_soft_delete",
    """SELECT user_id, CASE WHEN kind <> 'error' THEN kind END AS kind, n FROM
    (SELECT user_id, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2)""",
)
def soft_delete(spark, sf):
    events = load(spark, sf, "events")
    kinds = events.groupBy("user_id", F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    gone = events.where(F.col("event_type") == "error").select("user_id", F.col("event_type").alias("kind")).distinct()
    return merge_into(kinds, gone, ["user_id", "kind"], update={"kind": typed_null()})


@query(
    "merge_latest_wins",
    """SELECT c_custkey, c_mktsegment, coalesce(o_totalprice, c_acctbal) AS last_amount FROM customer LEFT JOIN
    (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    ON o_custkey = c_custkey""",
)
def latest_wins(spark, sf):
    customers = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("last_amount"))
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return merge_into(
        customers, orders, {"c_custkey": "o_custkey"}, update={"last_amount": "o_totalprice"},
        on_ambiguous="latest", order=["o_orderdate", "o_orderkey"],
    )


APPLY_SQL = f"""WITH {FEED_SQL}, snap AS (
    SELECT * FROM feed WHERE _change_type IN ('insert', 'update_postimage') QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY EventProcessedUtcTime DESC, _commit_version DESC, event_id DESC) = 1)
  SELECT coalesce(s_suppkey, user_id) AS id, s_name AS name, coalesce(value, s_acctbal) AS balance
  FROM supplier FULL JOIN snap ON user_id = s_suppkey WHERE Verb IS NULL OR Verb <> 'DELETE'"""


def _registry(spark, sf):
    return load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )


@query("apply_changes", APPLY_SQL)
def changes(spark, sf):
    """The latest event per user upserts a balance or removes the entry."""
    snap = latest_snapshot(live_changes(feed(spark, sf)), "user_id", ties="one", tiebreak=["event_id"])
    return apply_changes(
        _registry(spark, sf), snap, {"id": "user_id"}, update={"balance": "value"},
        insert={"id": "user_id", "balance": "value"},
    )


@query(
    "merge_fanout",
    f"""WITH {SUMMARY} SELECT 'amount' AS target, coalesce(id, o_orderkey) AS id, o_totalprice AS value
    FROM summary FULL JOIN orders ON o_orderkey = id
    UNION ALL SELECT 'status', o_orderkey, length(o_orderstatus) * 2.0::DOUBLE FROM orders""",
)
def fanout(spark, sf):
    """One source merged into two targets: the line summary and an empty status table."""
    summary = _summary(spark, sf).select("id", F.col("amount").alias("value"))
    empty = summary.where(F.lit(False))
    merged = merge_many(
        {"amount": summary, "status": empty},
        _orders(spark, sf),
        {
            "amount": MergeSpec.upsert({"id": "o_orderkey"}, {"value": "o_totalprice"}),
            "status": MergeSpec.upsert({"id": "o_orderkey"}, {"value": F.length(src("o_orderstatus")) * 2.0}),
        },
        on_ambiguous="assume_unique",
    )
    parts = [df.select(F.lit(name).alias("target"), "id", "value") for name, df in merged.items()]
    return parts[0].unionByName(parts[1])


SWEEP = """pairs AS (SELECT l_suppkey AS parent, l_suppkey::VARCHAR || '-' || l_partkey::VARCHAR AS child,
    bool_or(l_linestatus = 'O') AS live FROM lineitem GROUP BY 1, 2),
  changed AS (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0),
  expired AS (SELECT child FROM pairs WHERE NOT live AND parent IN (SELECT s_suppkey FROM changed))"""


@query(
    "mark_and_sweep",
    f"""WITH {SWEEP}
    SELECT 'children' AS part, child, parent FROM pairs WHERE child NOT IN (SELECT child FROM expired)
    UNION ALL SELECT 'expired', child, NULL FROM expired
    UNION ALL SELECT 'stock', child, parent FROM pairs WHERE child NOT IN (SELECT child FROM expired)""",
)
def sweep(spark, sf):
    """Products a supplier still has open lines for are current; of changed suppliers the others expire."""
    lines = load(spark, sf, "lineitem")
    child = F.concat(F.col("l_suppkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"))
    pairs = lines.select(
        F.col("l_suppkey").alias("parent"), child.alias("child"), (F.col("l_linestatus") == "O").alias("open")
    ).groupBy("parent", "child").agg(F.max("open").alias("live"))
    pairs = stage(pairs, run_dir(spark, "pairs"))  # the stored child table
    children = pairs.select("parent", "child")
    changed = load(spark, sf, "supplier").where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("parent"))
    current = pairs.where("live").select("parent", "child")
    done = mark_and_sweep(
        children, current, changed, "parent", "child", {"stock": (children, "child")}, expired_path=run_dir(spark, "expired")
    )
    return (
        done.children.withColumn("part", F.lit("children"))
        .unionByName(done.expired.withColumn("part", F.lit("expired")), allowMissingColumns=True)
        .unionByName(done.dependents["stock"].withColumn("part", F.lit("stock")))
    )
