"""Structured Streaming: landing events in bronze, and mapping bronze to silver as it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.plans.medallion import Medallion, bronze_rows
from quayside.sources.changes import append_changes, log_schema, newest_commit, path_exists


def json_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = 1000) -> DataFrame:
    """JSON lines files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def log_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """A bronze change log as it grows."""
    return spark.readStream.schema(log_schema(schema)).option("maxFilesPerTrigger", max_files).parquet(path)


def with_ingest_metadata(events: DataFrame, partitions: int = 4, key: str | None = None) -> DataFrame:
    """Add the ingest columns an event source would: arrival time, processing time and partition."""
    now = F.current_timestamp()
    spread = F.xxhash64(key) if key else F.xxhash64(*events.columns)
    columns = {
        "EventProcessedUtcTime": now,
        "PartitionId": F.pmod(spread, F.lit(partitions)).cast("bigint"),
        "EventEnqueuedUtcTime": now,
    }
    return events.withColumns({name: value for name, value in columns.items() if name not in events.columns})


def first_free_version(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The version after the last commit of a log when a stream first starts; kept beside its checkpoint from then on."""
    start = f"{checkpoint}-start"
    if not path_exists(spark, start):
        spark.range(1).select(F.lit(newest_commit(spark, path) + 1).cast("long").alias("version")).write.parquet(start)
    return spark.read.schema("version long").parquet(start).first()["version"]


def land_stream(
    source: DataFrame, path: str, checkpoint: str, *, first_version: int | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append a stream to a change log, one commit per micro-batch, after the commits that are already there.

    The commit version follows from the batch number and a batch overwrites its
    own version folder, so a batch that is retried after a failure lands once.
    A new checkpoint starts after all commits of the log and lands its source anew.
    While a stream lands, nothing else may commit to the same log.
    """
    if first_version is None:
        first_version = first_free_version(source.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, path, first_version + batch_id)

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def land_entity(lake: Medallion, entity: str, folder: str, checkpoint: str, **options) -> StreamingQuery:
    """JSON events of one entity into its bronze log."""
    source = with_ingest_metadata(bronze_rows(json_stream(lake.spark, folder, lake.bronze_schema(entity)), entity))
    return land_stream(source, lake.log_path(entity), checkpoint, **options)


def map_stream(
    lake: Medallion, entity: str, checkpoint: str, *, available_now: bool = True, max_files: int = 1000
) -> StreamingQuery:
    """Keep the silver tables of an entity up to date from its bronze log.

    The stream's checkpoint takes the place of the state log. The merges are
    idempotent, so a micro-batch that is run again changes nothing, and an event
    older than the newest one of its key changes nothing either, whichever
    batch brings it: ``max_files`` does not decide which event wins.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        lake.process(entity, batch, batch_id + 1)

    source = log_stream(lake.spark, lake.log_path(entity), lake.bronze_schema(entity), max_files)
    writer = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
