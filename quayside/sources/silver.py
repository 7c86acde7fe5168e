"""Silver tables: plain Parquet folders, laid out by hash bucket of one key column.

A batch reads and rewrites only the buckets that its keys fall into. The new content of those buckets is staged first and
then put in place by Spark's dynamic partition overwrite. A write that dies half-way is finished from the staged copy
before anything else is written under the same label, so no row is lost and the batch may simply run again.

Tables switch one after the other, so a reader that needs several tables of one moment should read between runs. One
writer per label at a time is assumed: an entity is the only writer of its tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import empty_frame
from quayside.sources.readers import mark_file, path_exists, remove_folder, subfolders
from quayside.sources.tables import conform

BUCKET, LIVE, READY = "_bucket", "_live", "_ready"
LAYOUT_SCHEMA = "table_name string, key string, buckets int"
#: Buckets of a table unless told otherwise. At scale choose so many that one holds some hundred megabytes.
BUCKETS = 16


class SilverTables:
    """Tables below ``root``: their columns, the key column that deals rows to buckets, and the number of buckets.

    The layout is recorded when the tables are created and read back later, so a later ``buckets`` changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: Mapping[str, T.StructType],
        keys: Mapping[str, str],
        buckets: int | Mapping[str, int] = BUCKETS,
        internal: Iterable[str] = (),
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(schemas)
        self.keys = dict(keys)
        self.internal = frozenset(internal)  # tables that ``tables()`` leaves out
        count = (lambda n: buckets.get(n, BUCKETS)) if isinstance(buckets, Mapping) else (lambda n: buckets)
        self.counts = {name: count(name) for name in self.schemas}
        self.staged, self.layout = f"{self.root}/staged", f"{self.root}/layout"
        if path_exists(spark, self.layout):
            self._recall()

    def create(self) -> SilverTables:
        """Record the layout; tables that are already recorded keep theirs."""
        rows = [(name, self.keys[name], self.counts[name]) for name in self.schemas]
        if path_exists(self.spark, self.layout):
            known = {r.table_name for r in self.spark.read.schema(LAYOUT_SCHEMA).parquet(self.layout).collect()}
            rows = [r for r in rows if r[0] not in known]
        if rows:
            self.spark.createDataFrame(rows, LAYOUT_SCHEMA).coalesce(1).write.mode("append").parquet(self.layout)
        return self

    def _recall(self) -> None:
        for row in self.spark.read.schema(LAYOUT_SCHEMA).parquet(self.layout).collect():
            if row.table_name not in self.schemas:
                continue
            if row.key != self.keys[row.table_name]:
                raise ValueError(f"{row.table_name} is laid out by {row.key}, not by {self.keys[row.table_name]}")
            self.counts[row.table_name] = row.buckets

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def bucket(self, name: str, key: str | Column) -> Column:
        key = F.col(key) if isinstance(key, str) else key
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.counts[name])).cast("int")

    def _stored(self, name: str) -> T.StructType:
        return T.StructType([*self.schemas[name].fields, T.StructField(LIVE, T.BooleanType()), T.StructField(BUCKET, T.IntegerType())])

    def _read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        if not path_exists(self.spark, self.path(name)):
            return empty_frame(self.spark, self.schemas[name])
        rows = self.spark.read.schema(self._stored(name)).parquet(self.path(name))
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(sorted(buckets)))
        return rows.where(LIVE).drop(LIVE, BUCKET)

    def table(self, name: str) -> DataFrame:
        """Current rows of a table; empty until something is written."""
        return self._read(name)

    def tables(self, *names: str) -> dict[str, DataFrame]:
        """Current rows of the given tables, or of all but the internal ones."""
        return {name: self._read(name) for name in (names or [n for n in self.schemas if n not in self.internal])}

    def buckets_of(self, name: str, *keys: DataFrame) -> frozenset[int]:
        """The buckets of a table that the keys (one column each) fall into: at most as many as the table has."""
        found: set[int] = set()
        for frame in keys:
            rows = frame.select(self.bucket(name, F.col(f"`{frame.columns[0]}`")).alias(BUCKET)).distinct().collect()
            found |= {row[0] for row in rows}
        return frozenset(found)

    def part(self, name: str, buckets: Iterable[int]) -> DataFrame:
        """Rows of some buckets; files of the others are not opened."""
        return self._read(name, buckets)

    def commit(self, new: Mapping[str, DataFrame], label: str = "load", touched: Mapping[str, Iterable[int]] | None = None) -> None:
        """Put the given rows in place of the ``touched`` buckets of each table, or of the whole table.

        Every touched bucket gets a row that stands for nothing, so that a bucket left without rows is overwritten too.
        """
        self.heal(label)
        work = f"{self.staged}/{label}/{uuid.uuid4().hex}"
        wanted = {name: sorted(touched[name] if touched and name in touched else range(self.counts[name])) for name in new}
        names = [name for name in new if wanted[name]]

        def write(name: str) -> None:
            rows = conform(new[name], self.schemas[name]).withColumn(LIVE, F.lit(True))
            rows = rows.withColumn(BUCKET, self.bucket(name, self.keys[name]))
            marks = self.spark.range(1).select(F.lit(False).alias(LIVE), F.explode(F.lit(wanted[name])).alias(BUCKET))
            rows = rows.unionByName(marks, allowMissingColumns=True)
            rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{work}/{name}")

        if names:
            self._each(write, names)
            mark_file(self.spark, f"{work}/{READY}")
            self._put(work)

    def _put(self, work: str) -> None:
        def overwrite(name: str) -> None:
            rows = self.spark.read.schema(self._stored(name)).parquet(f"{work}/{name}")
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
            writer.parquet(self.path(name))

        self._each(overwrite, subfolders(self.spark, work))
        remove_folder(self.spark, work)

    @staticmethod
    def _each(write: Callable[[str], None], names: Sequence[str]) -> None:
        """One Spark job per table, at the same time: small ones fill the gaps that large ones leave."""
        with ThreadPoolExecutor(max_workers=min(8, len(names))) as pool:
            list(pool.map(write, names))

    def heal(self, label: str) -> int:
        """Finish what a failed write of this label had staged whole, drop what it had not; returns how many were finished."""
        root, done = f"{self.staged}/{label}", 0
        for folder in subfolders(self.spark, root) if path_exists(self.spark, root) else []:
            work = f"{root}/{folder}"
            if path_exists(self.spark, f"{work}/{READY}"):
                self._put(work)
                done += 1
            else:
                remove_folder(self.spark, work)
        return done
