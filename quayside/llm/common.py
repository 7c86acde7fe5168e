"""What the operators share: the registry, table access, and bounded slices of Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Bytes of text that a Python task works on at a time; bounds its memory whatever the batch holds.
SLICE_BYTES = 4 << 20

_SHIPPED: set[str] = set()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its check in SQL where SQL can express it."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / "quayside.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores after it until no column of the frames has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Let Python workers take at most so many rows and bytes at a time, where the session leaves that to the default: texts
    may be long, and a batch is held by the JVM and the worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, "64MB", "67108864", "67108864b"):
        spark.conf.set(name, size)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(start, stop - start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, empty for null."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def as_text(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


class Memo(dict):
    """What ``make`` gives for a key, kept until ``most`` keys are held; then it starts anew."""

    def __init__(self, make: Callable, most: int) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value
