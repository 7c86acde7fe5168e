"""Table lifecycle: declare, write, empty, load in bulk, preview."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.session import empty_frame
from quayside.sources.readers import read_parquet, rows_to_df, subfolders


def declare_table(
    spark: SparkSession, name: str, schema: T.StructType, *, path: str | None = None, change_feed: bool = False
) -> None:
    """Create or replace an empty table with the given columns, all nullable.

    With ``change_feed`` the table also carries the change columns and is
    partitioned by commit version, so readers skip the versions they have seen.
    """
    from quayside.sources.changes import CHANGE_TYPE, COMMIT_VERSION

    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    if change_feed:
        fields += [T.StructField(CHANGE_TYPE, T.StringType()), T.StructField(COMMIT_VERSION, T.LongType())]
    writer = empty_frame(spark, T.StructType(fields)).write.mode("overwrite").format("parquet")
    if change_feed:
        writer = writer.partitionBy(COMMIT_VERSION)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones are null, others are dropped."""
    from pyspark.sql import functions as F

    present = {c.lower(): c for c in df.columns}
    return df.select(
        [
            (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Overwrite or append a parquet folder."""
    df.write.mode(mode).parquet(path)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).format("parquet").saveAsTable(name)


def load_folder_as_tables(spark: SparkSession, root: str, database: str | None = None) -> list[str]:
    """One managed table per parquet folder below ``root``; returns the table names."""
    names = []
    for folder in subfolders(spark, root):
        name = f"`{database}`.`{folder}`" if database else f"`{folder}`"
        save_as_table(read_parquet(spark, f"{root}/{folder}"), name)
        names.append(name)
    return names


def truncate_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Empty every table that exists, keeping its columns; returns the names that do not exist."""
    missing = []
    for name in names:
        if spark.catalog.tableExists(name):
            spark.sql(f"TRUNCATE TABLE {name}")
        else:
            missing.append(name)
    return missing


def seed_dimension(
    spark: SparkSession, ids: Sequence[int | str], names: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Reference rows ``(id, name[, empty description])`` from two parallel lists."""
    key_type = "string" if isinstance(ids[0], str) else "bigint"
    ddl = ", ".join([f"`{columns[0]}` {key_type}"] + [f"`{c}` string" for c in columns[1:]])
    blanks = ("",) * (len(columns) - 2)
    return rows_to_df(spark, [(key, name, *blanks) for key, name in zip(ids, names, strict=True)], ddl)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Snapshot for repeated metric reads: a parquet copy when a path is given, else a cached frame."""
    if path is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    from quayside.session import stage

    return stage(df, path)


@contextmanager
def with_view(df: DataFrame, name: str) -> Iterator[str]:
    """A session view for the length of a block."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    return df.limit(n)
