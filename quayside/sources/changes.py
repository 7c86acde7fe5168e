"""Change log: rows stamped with a commit version and a change type.

The log is a parquet folder partitioned by version. A batch is written into its
own version folder in overwrite mode, so a retried batch replaces itself, and
reading from a version on touches only the folders of those versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import empty_frame
from quayside.sources.readers import matching, path_exists

COMMIT_VERSION = "_commit_version"
CHANGE_TYPE = "_change_type"

# The change types of the feed.
INSERT = "insert"
UPDATE_BEFORE = "update_preimage"
UPDATE_AFTER = "update_postimage"
DELETE = "delete"


def log_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField(CHANGE_TYPE, T.StringType()), T.StructField(COMMIT_VERSION, T.LongType())]
    )


def append_changes(df: DataFrame, path: str, version: int, mode: str = "overwrite") -> None:
    """Write one commit. Rows without a change type are inserts."""
    rows = df if CHANGE_TYPE in df.columns else df.withColumn(CHANGE_TYPE, F.lit(INSERT))
    rows.drop(COMMIT_VERSION).write.mode(mode).parquet(f"{path}/{COMMIT_VERSION}={version}")


def append_commit(df: DataFrame, path: str) -> int:
    """Write one commit under the next free version and return it.

    A version folder that is already there, left by another landing at the same time or by a failed one, is never
    written into: the next number is tried.
    """
    version = newest_commit(df.sparkSession, path) + 1
    while True:
        try:
            append_changes(df, path, version, mode="errorifexists")
            return version
        except AnalysisException as taken:
            if taken.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            version += 1


def open_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log, without rows before its first commit."""
    if not path_exists(spark, path):
        return empty_frame(spark, log_schema(schema))
    return spark.read.schema(log_schema(schema)).parquet(path)


def read_changes(log: DataFrame, from_version: int, to_version: int | None = None) -> DataFrame:
    """Changes from a version on, inclusive.

    Give the latest known version as upper bound: without it a commit arriving
    during the run is read now and once more in the next run.
    """
    changes = log.where(F.col(COMMIT_VERSION) >= from_version)
    return changes if to_version is None else changes.where(F.col(COMMIT_VERSION) <= to_version)


def latest_version(log: DataFrame) -> DataFrame:
    """One row with the highest committed version."""
    return log.agg(F.max(COMMIT_VERSION).alias("version"))


def newest_commit(spark: SparkSession, path: str) -> int:
    """Highest finished version of a log, 0 before the first one, by folder names: no file of the log is opened.

    A folder counts once its write has left the ``_SUCCESS`` mark, so a commit under way is not taken for a whole one.
    """
    return max(finished_commits(spark, path), default=0)


def finished_commits(spark: SparkSession, path: str) -> list[int]:
    """Versions whose write has ended, by one listing."""
    marks = matching(spark, f"{path}/{COMMIT_VERSION}=*/_SUCCESS")
    return sorted(int(m.split("/")[-2].removeprefix(f"{COMMIT_VERSION}=")) for m in marks)


def open_window(spark: SparkSession, path: str, schema: T.StructType, first: int, last: int) -> DataFrame:
    """Changes of the finished versions from ``first`` to ``last``; only their folders are opened."""
    folders = [f"{path}/{COMMIT_VERSION}={v}" for v in finished_commits(spark, path) if first <= v <= last]
    if not folders:
        return empty_frame(spark, log_schema(schema))
    return spark.read.schema(log_schema(schema)).option("basePath", path).parquet(*folders)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], *, images: bool = True) -> DataFrame:
    """The changes that turn ``before`` into ``after``; both unique on ``keys``.

    Rows missing afterwards become ``delete``, new ones ``insert``; changed rows
    give a pair of update images, or with ``images=False`` only the later one.
    A null key is one key. Both sides are united and meet in one aggregate: one
    shuffle by key, whatever the keys' nulls, and no outer join.
    """
    values = [c for c in after.columns if c not in keys]

    def side(df: DataFrame, old: bool) -> DataFrame:
        return df.select(F.struct(*keys).alias("_key"), F.struct(*values).alias("_image"), F.lit(old).alias("_is_old"))

    image = F.col("_image")
    both = side(before, True).unionByName(side(after, False)).groupBy("_key").agg(
        F.first(F.when(F.col("_is_old"), image), ignorenulls=True).alias("_old"),
        F.first(F.when(~F.col("_is_old"), image), ignorenulls=True).alias("_new"),
    )
    joined = both.select("_key.*", "_old", "_new")

    def change(kind: str, image: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(image).alias("image"))

    updated = F.array(change(UPDATE_BEFORE, "_old"), change(UPDATE_AFTER, "_new")) if images else F.array(
        change(UPDATE_AFTER, "_new")
    )
    changes = (
        F.when(F.col("_old").isNull(), F.array(change(INSERT, "_new")))
        .when(F.col("_new").isNull(), F.array(change(DELETE, "_old")))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), updated)
    )
    return joined.select(*keys, F.explode(changes).alias("_change")).select(
        *keys, *[F.col(f"_change.image.{c}").alias(c) for c in values], F.col("_change.kind").alias(CHANGE_TYPE)
    )


def overwrite_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Feed of a full overwrite: every old row deleted, every new row inserted."""
    return before.withColumn(CHANGE_TYPE, F.lit(DELETE)).unionByName(after.withColumn(CHANGE_TYPE, F.lit(INSERT)))
