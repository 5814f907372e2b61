"""Session settings and shared working folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app: str = "ledgerpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    Adaptive execution coalesces small shuffle partitions, splits skewed join
    partitions and turns joins into broadcasts only from measured sizes.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ledgerpulse-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, computed once, written to the shared folder and read from there; they survive lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to a few tasks per core, for work that is heavy for its bytes, which Spark would leave to few tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
