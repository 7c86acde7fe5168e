"""The landing and mapping streams, run to the end of the given events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators.merge import apply_changes
from quayside.operators.snapshot import EVENT_TIME
from quayside.plans.entities import Entity
from quayside.plans.medallion import Medallion
from quayside.session import run_dir, use_utc
from quayside.sources.changes import CHANGE_TYPE, COMMIT_VERSION, open_log
from quayside.streaming.jobs import land_stream, map_stream, with_ingest_metadata
from quayside.workload import bronze, query
from quayside.workload.inputs import feed, load
from quayside.workload.merges import APPLY_SQL, _registry


@query("stream_land", "SELECT event_id, event_type, user_id, true AS stamped FROM events")
def land(spark, sf):
    """Events as a file stream into a change log, with ingest times and partition."""
    use_utc(spark)
    root = run_dir(spark, "land")
    schema = load(spark, sf, "events").schema
    source = with_ingest_metadata(spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*"), key="user_id")
    land_stream(source, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    log = open_log(spark, f"{root}/log", source.schema)
    stamped = F.col("EventProcessedUtcTime").isNotNull() & F.col("PartitionId").between(0, 3)
    return log.select("event_id", "event_type", "user_id", (stamped & (F.col("_commit_version") >= 1)).alias("stamped"))


def _registry_job(changes, targets, run):
    """Latest event per user into the registry: an upsert of the balance, or a removal."""
    events = changes.drop(COMMIT_VERSION, CHANGE_TYPE).withColumnsRenamed({"version": COMMIT_VERSION, "kind": CHANGE_TYPE})
    snap, rows = run.snapshot(events, "user_id", "registry", tie="event_id")
    known = run.part(targets, "registry", snap.select("user_id"))
    merged = apply_changes(
        known, snap, {"id": "user_id"}, update={"balance": "value"}, insert={"id": "user_id", "balance": "value"},
        on_ambiguous=run.ambiguity, source_rows=rows,
    )
    return {"registry": merged}


def _third(files):
    """A third of the files of a frame, rounded up."""
    return max(1, -(-len(files.inputFiles()) // 3))


@query("stream_land_and_map", APPLY_SQL)
def land_and_map(spark, sf):
    """The feed landed by one stream, newest events first, and merged into a registry by a second one, a third of the files
    at a time: a file per task of the scan, so no third passes one task and more events make no more batches."""
    root = run_dir(spark, "map")
    rows = feed(spark, sf).withColumnsRenamed({COMMIT_VERSION: "version", CHANGE_TYPE: "kind"})
    newest_first = F.ntile(3).over(Window.orderBy(F.desc("day"))).alias("part")
    parts = rows.select(F.col(EVENT_TIME).alias("day")).distinct().select("day", newest_first)
    dealt = rows.join(F.broadcast(parts), rows[EVENT_TIME].eqNullSafe(parts["day"])).drop("day")
    for part in (1, 2, 3):
        dealt.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _third(spark.read.schema(rows.schema).parquet(f"{root}/in")))
    source = source.parquet(f"{root}/in")
    registry = _registry(spark, sf)
    own = Entity(rows.schema, _registry_job, {"registry": registry.schema}, {"registry": "id"})
    lake = Medallion(spark, f"{root}/lake", more={"Registry": own}, buckets=4)
    lake.store.create().commit({"registry": registry})
    land_stream(source, lake.log_path("Registry"), f"{root}/land").awaitTermination()
    map_stream(lake, "Registry", f"{root}/map", max_files=_third(lake.log("Registry"))).awaitTermination()
    return lake.store.table("registry")


@query(
    "medallion_run",
    """SELECT 'SC-' || c_custkey::VARCHAR AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END || ' ' || c_name
       AS name, lower(c_name) || '@example.com' AS email, 1::BIGINT AS runs, false AS ran_again FROM customer WHERE c_acctbal >= 0""",
)
def incremental_run(spark, sf):
    """Customers landed in two commits: their events, then the same events as of a day earlier under other names. The run
    takes both; a further run finds nothing new; one after a third, older commit changes nothing but the state."""
    lake = Medallion(spark, run_dir(spark, "lake"), buckets=4).create(["Users"])
    events = bronze.users(spark, sf).drop(COMMIT_VERSION, CHANGE_TYPE)
    old = events.withColumns(
        {
            EVENT_TIME: F.col(EVENT_TIME) - F.expr("INTERVAL 1 DAY"),
            "Verb": F.lit("PUT"),
            "Response": F.col("Response").withField("Body.FirstName", F.lit("old")).withField("Body.ID", F.col("RouteParams.userID")),
        }
    )
    lake.land("Users", events)
    lake.land("Users", old)
    first, again = lake.run("Users"), lake.run("Users")
    lake.land("Users", old)
    late = lake.run("Users")
    silver = lake.store.tables("IndividualCustomer", "CustomerEmail")
    joined = silver["IndividualCustomer"].join(silver["CustomerEmail"], "CustomerId", "full_outer")
    return joined.select(
        F.col("CustomerId").alias("id"),
        F.col("IndividualCustomerName").alias("name"),
        F.col("EmailAddress").alias("email"),
        F.lit(int(first) + int(late) - 1).cast("bigint").alias("runs"),
        F.lit(again).alias("ran_again"),
    )
