"""Scans: files by any Hadoop URI, catalog tables and databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines. Give a schema for large folders: without one Spark reads the data twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with every column as text; callers cast what they need."""
    return spark.read.option("header", header).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read(spark: SparkSession, uri: str, fmt: str = "parquet", **options: Any) -> DataFrame:
    """Any format from an absolute URI, for data in another lake."""
    return spark.read.format(fmt).options(**options).load(uri)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def rows_to_df(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A few inline rows under an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def jdbc_options(
    url: str,
    schema: str,
    item: str,
    *,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 64,
    **extra: str,
) -> dict[str, str]:
    """Reader options for one database table, read in parallel ranges when a split column is given."""
    options = {"url": url, "dbtable": f'"{schema}"."{item}"', "fetchsize": "10000", **extra}
    if split_column is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs its lower and upper bound")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_sql_table(
    spark: SparkSession, schema: str, item: str, jdbc: Mapping[str, Any] | None = None
) -> DataFrame:
    """A table of the metrics database: through JDBC when a connection is given, else from the catalog."""
    if jdbc is None:
        return spark.read.table(f"`{schema}`.`{item}`")
    connection = dict(jdbc)
    return spark.read.format("jdbc").options(**jdbc_options(connection.pop("url"), schema, item, **connection)).load()


def _filesystem(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _filesystem(spark, uri)
    return fs.exists(path)


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Delete a working folder of our own, if it is there."""
    path, fs = _filesystem(spark, uri)
    fs.delete(path, True)


def mark_file(spark: SparkSession, uri: str) -> None:
    """An empty file that says by its presence that something is done."""
    path, fs = _filesystem(spark, uri)
    fs.create(path, True).close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, found by one listing."""
    path, fs = _filesystem(spark, pattern)
    return [e.getPath().toString() for e in fs.globStatus(path) or []]


def stored_bytes(spark: SparkSession, uri: str) -> int:
    """Size of a folder in storage."""
    path, fs = _filesystem(spark, uri)
    return fs.getContentSummary(path).getLength()


def subfolders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root``, on whatever file system it lives."""
    path, fs = _filesystem(spark, root)
    return sorted(e.getPath().getName() for e in fs.listStatus(path) if e.isDirectory())
