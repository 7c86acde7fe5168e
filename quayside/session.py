"""Session set-up and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "quayside", cores: str | int = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"),
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: event times and sentinels are UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="quayside-")
    return _LOCAL_DIRS[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows under a schema, known to be empty when a plan is made: joins with it vanish."""
    return spark.range(1).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).where(F.lit(False))


def stage(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Cut lineage by writing ``df`` once, with the writer's ``options``, and reading it back.

    Unlike a cached frame this survives the loss of executors, and unlike an
    RDD checkpoint every later reader still prunes columns.
    """
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
