"""Incremental state: an append log of the last version processed per table.

It holds one small row per table and run; the newest value is the maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.changes import COMMIT_VERSION

STATE_SCHEMA = "last_processed_commit_version bigint, last_processed_timestamp timestamp, table_name string"


def _row(spark: SparkSession, entries: Sequence[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(
        [(int(version), name) for name, version in entries],
        "last_processed_commit_version bigint, table_name string",
    ).select(
        "last_processed_commit_version",
        F.current_timestamp().alias("last_processed_timestamp"),
        "table_name",
    )


def init_state(spark: SparkSession, path: str, tables: Sequence[str]) -> None:
    """Start every table at version 0, so the first commit is read."""
    _row(spark, [(name, 0) for name in tables]).coalesce(1).write.mode("overwrite").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def advance(spark: SparkSession, path: str, table: str, version: int) -> None:
    """Record a version as processed; call it after every target is written."""
    _row(spark, [(table, version)]).coalesce(1).write.mode("append").parquet(path)


def version_window(state: DataFrame, log: DataFrame, table: str) -> DataFrame:
    """One row ``(next_version, latest_version)``; a table unknown to the state starts at 1."""
    nothing = F.lit(None).cast("bigint")
    done = state.where(F.col("table_name") == table).select(
        F.col("last_processed_commit_version").alias("done"), nothing.alias("latest")
    )
    seen = log.select(nothing.alias("done"), F.col(COMMIT_VERSION).cast("bigint").alias("latest"))
    return done.unionByName(seen).agg(
        (F.coalesce(F.max("done"), F.lit(0).cast("bigint")) + 1).alias("next_version"),
        F.max("latest").alias("latest_version"),
    )


def next_version(state: DataFrame, table: str) -> int:
    done = state.where(F.col("table_name") == table).agg(F.max("last_processed_commit_version")).first()[0]
    return (done or 0) + 1


def has_new_data(next_ver: int, latest: int | None) -> bool:
    return latest is not None and next_ver <= latest


def max_value(df: DataFrame, column: str):
    """One scalar to the driver."""
    return df.agg(F.max(column)).first()[0]
