"""Sources, sinks and the table lifecycle, on copies in the run's own folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.functions.conditional import null_if_empty
from quayside.plans.model import order_status_types
from quayside.session import run_dir
from quayside.sources import readers, tables
from quayside.sources.changes import append_changes, open_log, read_changes
from quayside.sources.silver import SilverTables
from quayside.workload import query
from quayside.workload.inputs import load


def fresh(name: str) -> str:
    return f"quayside_{name}_{uuid.uuid4().hex[:12]}"


@query(
    "overwrite_and_append",
    """SELECT s_suppkey AS id, s_name AS name, 'supplier' AS kind FROM supplier
    UNION ALL SELECT c_custkey, c_name, 'customer' FROM customer""",
)
def overwrite_append(spark, sf):
    path = run_dir(spark, "parties")
    suppliers = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    customers = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    tables.write(customers, path, "overwrite")
    tables.write(suppliers, path, "overwrite")
    tables.write(customers, path, "append")
    return readers.read_parquet(spark, path)


@query("read_json", "SELECT event_id, user_id, event_type, value FROM events")
def json_round(spark, sf):
    path = run_dir(spark, "events-json")
    rows = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    rows.write.json(path)
    return readers.read_json(spark, path, rows.schema)


@query(
    "read_csv",
    "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_orderpriority FROM orders",
)
def csv_round(spark, sf):
    path = run_dir(spark, "orders-csv")
    load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option("header", True).csv(path)
    return readers.read_csv(spark, path)


@query("read_uri", "SELECT l_orderkey, l_partkey FROM lineitem")
def by_uri(spark, sf):
    """A scan by absolute URI; only the two columns are read from the files."""
    uri = sf if "://" in sf else f"file://{sf}"
    lines = readers.read(spark, f"{uri}/lineitem.parquet")
    return lines.select("l_orderkey", "l_partkey")


@query(
    "declare_and_save_table",
    "SELECT p_partkey, p_name, 1::BIGINT AS version FROM part",
)
def declared(spark, sf):
    """A declared table with change columns, filled by one commit and read from that version on."""
    name, path = fresh("part"), run_dir(spark, "declared")
    rows = load(spark, sf, "part").select("p_partkey", "p_name")
    tables.declare_table(spark, name, rows.schema, path=path, change_feed=True)
    append_changes(rows, path, 1)
    spark.sql(f"DROP TABLE {name}")
    log = open_log(spark, path, rows.schema)
    return read_changes(log, 1).select("p_partkey", "p_name", F.col("_commit_version").alias("version"))


@query("save_as_table", "SELECT s_suppkey, s_name FROM supplier")
def saved(spark, sf):
    name = fresh("supplier")
    tables.save_as_table(load(spark, sf, "supplier").select("s_suppkey", "s_name"), name)
    return readers.table(spark, name)


@query(
    "load_folder_as_tables",
    "SELECT 'nation' AS part, n_name AS name FROM nation UNION ALL SELECT 'supplier', s_name FROM supplier",
)
def folders(spark, sf):
    """Two parquet folders loaded as one table each, under names of this run."""
    root, tag = run_dir(spark, "folders"), uuid.uuid4().hex[:12]
    load(spark, sf, "nation").write.parquet(f"{root}/nation_{tag}")
    load(spark, sf, "supplier").write.parquet(f"{root}/supplier_{tag}")
    nation, supplier = tables.load_folder_as_tables(spark, root)
    first = readers.read_sql_table(spark, "default", nation.strip("`")).select(
        F.lit("nation").alias("part"), F.col("n_name").alias("name")
    )
    second = readers.table(spark, supplier).select(F.lit("supplier").alias("part"), F.col("s_name").alias("name"))
    return first.unionByName(second)


@query(
    "truncate_tables",
    "SELECT count(*) AS before, 0::BIGINT AS after, 1 AS missing FROM customer",
)
def truncated(spark, sf):
    name = fresh("customer")
    tables.save_as_table(load(spark, sf, "customer").select("c_custkey"), name)
    before = readers.table(spark, name).count()
    missing = tables.truncate_tables(spark, [name, fresh("absent")])
    after = readers.table(spark, name).agg(F.count(F.lit(1)).alias("after"))
    return after.select(F.lit(before).cast("bigint").alias("before"), "after", F.lit(len(missing)).alias("missing"))


@query(
    "seed_dimension",
    """SELECT name AS status, CAST(id AS BIGINT) AS id, count(o_orderkey) AS orders FROM (VALUES (0, 'Unsubmitted'),
      (1, 'AwaitingApproval'), (2, 'Declined'), (3, 'Open'), (4, 'Completed'), (5, 'Canceled')) v(id, name)
    LEFT JOIN orders ON id = CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 ELSE 1 END GROUP BY name, id""",
)
def seeded(spark, sf):
    """The seeded statuses with the orders that have them."""
    status = F.when(F.col("o_orderstatus") == "O", 3).when(F.col("o_orderstatus") == "F", 4).otherwise(1)
    counts = load(spark, sf, "orders").groupBy(status.cast("bigint").alias("id")).agg(F.count(F.lit(1)).alias("orders"))
    names = order_status_types(spark).select(
        F.col("OrderStatusTypeName").alias("status"), F.col("OrderStatusTypeId").alias("id")
    )
    return names.join(counts, "id", "left").select("status", "id", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))


@query("with_view", "SELECT r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def viewed(spark, sf):
    regions, nations = load(spark, sf, "region"), load(spark, sf, "nation")
    with tables.with_view(regions, fresh("r")) as r, tables.with_view(nations, fresh("n")) as n:
        return spark.sql(
            f"SELECT r_name, count(*) AS nations FROM {r} JOIN {n} ON n_regionkey = r_regionkey GROUP BY r_name"
        )


@query("materialize", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey")
def materialized(spark, sf):
    counts = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return tables.materialize(counts, run_dir(spark, "snapshot"))


@query(
    "silver_store",
    "SELECT 'SC-' || c_custkey::VARCHAR AS \"CustomerId\", c_name AS \"IndividualCustomerName\" FROM customer",
)
def stored(spark, sf):
    """A table in key buckets: all customers under an old name, then the buckets of one half written again, then of the other."""
    schema = load(spark, sf, "customer").select(
        F.concat(F.lit("SC-"), F.col("c_custkey").cast("string")).alias("CustomerId"),
        F.col("c_name").alias("IndividualCustomerName"),
    )
    name = "IndividualCustomer"
    store = SilverTables(spark, run_dir(spark, "silver"), {name: schema.schema}, {name: "CustomerId"}, 8).create()
    store.commit({name: schema.withColumn("IndividualCustomerName", F.lit("old"))})
    for half in (range(4), range(4, 8)):
        rows = schema.where(store.bucket(name, "CustomerId").isin(list(half)))
        store.commit({name: rows}, touched={name: store.buckets_of(name, rows.select("CustomerId"))})
    return store.table(name)


@query(
    "null_if_empty",
    """SELECT doc_id, CAST(nullif(len(list_filter(string_split(text, ' '), lambda w: contains(w, '@'))), 0) AS INTEGER) AS n
    FROM documents""",
)
def emptied(spark, sf):
    found = F.filter(F.split("text", " "), lambda w: F.contains(w, F.lit("@")))
    return load(spark, sf, "documents").select("doc_id", F.size(null_if_empty(found)).alias("n"))
