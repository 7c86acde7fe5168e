"""Change feed, incremental state and latest snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.text import external_key, prefix_key
from quayside.operators.snapshot import (
    accept_ok_events,
    drop_null_keys,
    flatten_event,
    latest_snapshot,
    live_changes,
    max_over,
    split_by_verb,
)
from quayside.session import run_dir
from quayside.sources.changes import (
    append_commit,
    latest_version,
    newest_commit,
    open_window,
    overwrite_changes,
    read_changes,
    snapshot_diff,
)
from quayside.sources.state import advance, has_new_data, init_state, max_value, next_version, read_state, version_window
from quayside.workload import query
from quayside.workload.inputs import FEED_SQL, feed, load

SNAP = ["user_id", "event_id", "Verb", "EventProcessedUtcTime", "_commit_version"]
SNAP_SQL = ", ".join(SNAP)
LIVE_SQL = "_change_type IN ('insert', 'update_postimage')"


@query(
    "latest_snapshot_ties",
    f"""WITH {FEED_SQL}, live AS (SELECT * FROM feed WHERE {LIVE_SQL} AND user_id IS NOT NULL)
    SELECT {SNAP_SQL} FROM live
    QUALIFY rank() OVER (PARTITION BY user_id ORDER BY EventProcessedUtcTime DESC, _commit_version DESC) = 1""",
)
def latest_snapshot_ties(spark, sf):
    return latest_snapshot(live_changes(feed(spark, sf)), "user_id").select(*SNAP)


@query(
    "latest_snapshot_one",
    f"""WITH {FEED_SQL}, live AS (SELECT * FROM feed WHERE {LIVE_SQL} AND user_id IS NOT NULL)
    SELECT {SNAP_SQL} FROM live QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY EventProcessedUtcTime DESC, _commit_version DESC, event_id DESC) = 1""",
)
def latest_snapshot_one(spark, sf):
    return latest_snapshot(live_changes(feed(spark, sf)), "user_id", ties="one", tiebreak=["event_id"]).select(*SNAP)


@query(
    "max_over_partition",
    "SELECT event_id, user_id, value, max(value) OVER (PARTITION BY user_id) AS top FROM events",
)
def max_over_partition(spark, sf):
    return max_over(load(spark, sf, "events"), "value", ["user_id"], "top").select("event_id", "user_id", "value", "top")


@query(
    "live_changes",
    f"""WITH {FEED_SQL} SELECT event_id, _change_type, 'strict' AS rule FROM feed WHERE {LIVE_SQL}
    UNION ALL SELECT event_id, _change_type, 'lenient' FROM feed WHERE _change_type <> 'delete'""",
)
def live(spark, sf):
    rows = feed(spark, sf).select("event_id", "_change_type")
    strict = live_changes(rows).withColumn("rule", F.lit("strict"))
    return strict.unionByName(live_changes(rows, strict=False).withColumn("rule", F.lit("lenient")))


@query(
    "read_changes_since",
    f"""WITH {FEED_SQL} SELECT event_id, _change_type, _commit_version FROM feed WHERE _commit_version >= 1""",
)
def read_changes_since(spark, sf):
    """The feed written as a log with one folder per version, then read from the first unseen version on."""
    path = run_dir(spark, "changes")
    rows = feed(spark, sf).select("event_id", "_change_type", "_commit_version")
    rows.repartition("_commit_version").write.partitionBy("_commit_version").parquet(path)
    log = spark.read.schema(rows.schema).parquet(path)
    return read_changes(log, 1).select("event_id", "_change_type", "_commit_version")


@query(
    "read_changes_bounded",
    f"""WITH {FEED_SQL} SELECT event_id, _commit_version FROM feed
    WHERE _commit_version BETWEEN 1 AND (SELECT max(_commit_version) FROM feed WHERE Verb = 'DELETE')""",
)
def read_changes_bounded(spark, sf):
    """Up to the version known when the run starts: here the newest one that holds a deletion."""
    log = feed(spark, sf)
    known = max_value(split_by_verb(log)[1], "_commit_version")
    return read_changes(log, 1, known).select("event_id", "_commit_version")


@query(
    "incremental_state",
    f"""WITH {FEED_SQL} SELECT Verb AS table_name, max(_commit_version) AS version, 2::BIGINT AS entries
    FROM feed GROUP BY Verb""",
)
def incremental_state(spark, sf):
    """The state log started at zero for each verb and advanced to the newest version of each."""
    path = run_dir(spark, "state")
    newest = feed(spark, sf).groupBy("Verb").agg(F.max("_commit_version").alias("v")).collect()
    init_state(spark, path, [row.Verb for row in newest])
    for row in newest:  # three verbs
        advance(spark, path, row.Verb, row.v)
    return read_state(spark, path).groupBy("table_name").agg(
        F.max("last_processed_commit_version").alias("version"), F.count(F.lit(1)).alias("entries")
    )


@query("latest_version", f"WITH {FEED_SQL} SELECT max(_commit_version) AS version FROM feed")
def newest_version(spark, sf):
    return latest_version(feed(spark, sf))


@query(
    "next_version",
    f"""WITH {FEED_SQL}
    SELECT (SELECT coalesce(max(_commit_version), 0) + 1 FROM feed WHERE _change_type = 'delete' AND Verb = 'PATCH')
           AS next_version, (SELECT max(_commit_version) FROM feed) AS latest_version""",
)
def next_version_window(spark, sf):
    """The state log records, per verb, the versions of the feed's deletes; the feed is the log to catch up with."""
    log = feed(spark, sf)
    state = log.where(F.col("_change_type") == "delete").select(
        F.col("_commit_version").alias("last_processed_commit_version"),
        F.col("ts").alias("last_processed_timestamp"),
        F.col("Verb").alias("table_name"),
    )
    return version_window(state, log, "PATCH")


@query(
    "commit_window",
    f"""WITH {FEED_SQL} SELECT 3::BIGINT AS newest, 2::BIGINT AS next, true AS new_data, false AS more, event_id, Verb FROM feed
    WHERE Verb <> 'DELETE'""",
)
def commit_window(spark, sf):
    """The feed in three commits, one per verb, the first of them processed. What a run does before it maps anything: the
    next version by the state, the newest one by the folders of the log, the gate, and the rows of the window."""
    root = run_dir(spark, "window")
    rows = feed(spark, sf).select("event_id", "Verb")
    for verb in ("DELETE", "PATCH", "POST"):
        append_commit(rows.where(F.col("Verb") == verb), f"{root}/log")
    init_state(spark, f"{root}/state", ["feed"])
    advance(spark, f"{root}/state", "feed", 1)
    first, newest = next_version(read_state(spark, f"{root}/state"), "feed"), newest_commit(spark, f"{root}/log")
    window = open_window(spark, f"{root}/log", rows.schema, first, newest)
    advance(spark, f"{root}/state", "feed", newest)
    after = next_version(read_state(spark, f"{root}/state"), "feed")
    return window.select(
        F.lit(newest).cast("bigint").alias("newest"),
        F.lit(first).cast("bigint").alias("next"),
        F.lit(has_new_data(first, newest)).alias("new_data"),
        F.lit(has_new_data(after, newest)).alias("more"),
        "event_id",
        "Verb",
    )


@query("accept_ok_events", "SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def ok_events(spark, sf):
    report = F.when(F.col("event_type") == "error", F.array(F.col("props")))
    events = load(spark, sf, "events").withColumn(
        "Response", F.struct(F.struct(report.alias("Errors")).alias("Body"))
    )
    return accept_ok_events(events).select("event_id", "event_type")


@query("split_upserts", f"WITH {FEED_SQL} SELECT event_id, Verb FROM feed WHERE Verb <> 'DELETE'")
def split_upserts(spark, sf):
    return split_by_verb(feed(spark, sf))[0].select("event_id", "Verb")


@query("split_deletes", f"WITH {FEED_SQL} SELECT event_id, Verb FROM feed WHERE Verb = 'DELETE'")
def split_deletes(spark, sf):
    return split_by_verb(feed(spark, sf))[1].select("event_id", "Verb")


@query(
    "external_key",
    """SELECT event_id, 'SC-' || coalesce(CASE WHEN event_type <> 'click' THEN user_id END, event_id)::VARCHAR AS key,
       'SC-' || user_id::VARCHAR AS user_key FROM events""",
)
def keys(spark, sf):
    body = F.when(F.col("event_type") != "click", F.col("user_id"))
    return load(spark, sf, "events").select(
        "event_id", external_key(body, "event_id").alias("key"), prefix_key("user_id").alias("user_key")
    )


@query(
    "drop_null_keys",
    "SELECT event_id, user_id FROM events WHERE user_id IS NOT NULL AND event_type <> 'view'",
)
def null_keys(spark, sf):
    rows = load(spark, sf, "events").withColumn("key", F.when(F.col("event_type") != "view", F.col("user_id")))
    return drop_null_keys(rows, ["key"]).select("event_id", "user_id")


@query(
    "flatten_event",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type AS kind FROM events""",
)
def flatten(spark, sf):
    body = F.struct(F.from_json("props", "k int").alias("Data"), F.col("event_type").alias("Kind"))
    events = load(spark, sf, "events").withColumn("Response", F.struct(body.alias("Body")))
    return flatten_event(events, {"event_id": "event_id", "k": "Response.Body.Data.k", "kind": "Response.Body.Kind"})


SALES = """
  sales AS (SELECT l_partkey, l_shipdate < TIMESTAMP '1998-07-01' AS early,
                   CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem),
  b AS (SELECT l_partkey, count(*) AS n, CAST(sum(q) AS DOUBLE) AS qty FROM sales WHERE early GROUP BY l_partkey),
  a AS (SELECT l_partkey, count(*) AS n, CAST(sum(q) AS DOUBLE) AS qty FROM sales WHERE NOT early GROUP BY l_partkey)
"""


def _sales(spark, sf):
    """What each part sold in the first and in the second half of the line table's years."""
    lines = load(spark, sf, "lineitem").select(
        "l_partkey",
        (F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz")).alias("early"),
        F.col("l_quantity").cast("decimal(18,2)").alias("q"),
    )

    def half(rows):
        return rows.groupBy("l_partkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum("q").cast("double").alias("qty")
        )

    return half(lines.where("early")), half(lines.where("NOT early"))


@query(
    "snapshot_diff",
    f"""WITH {SALES}, j AS (SELECT coalesce(b.l_partkey, a.l_partkey) AS k, b.n AS bn, b.qty AS bq, a.n AS an, a.qty AS aq
                 FROM b FULL JOIN a ON a.l_partkey = b.l_partkey)
    SELECT k AS l_partkey, an AS n, aq AS qty, 'insert' AS _change_type FROM j WHERE bn IS NULL
    UNION ALL SELECT k, bn, bq, 'delete' FROM j WHERE an IS NULL
    UNION ALL SELECT k, bn, bq, 'update_preimage' FROM j WHERE an <> bn OR aq <> bq
    UNION ALL SELECT k, an, aq, 'update_postimage' FROM j WHERE an <> bn OR aq <> bq""",
)
def diff(spark, sf):
    before, after = _sales(spark, sf)
    return snapshot_diff(before, after, ["l_partkey"])


@query(
    "overwrite_changes",
    f"""WITH {SALES} SELECT l_partkey, n, qty, 'delete' AS _change_type FROM b
    UNION ALL SELECT l_partkey, n, qty, 'insert' FROM a""",
)
def overwrite(spark, sf):
    return overwrite_changes(*_sales(spark, sf))
