"""The append-only alert table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.schemas import ALERTS
from ledgerpulse.sources.files import path_exists


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Add alerts; the folder is created on first use. Appending never rewrites old rows."""
    alerts.select(*ALERTS.names).write.mode("append").parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts; an empty table if none was ever written."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], ALERTS)
    return spark.read.schema(ALERTS).option("recursiveFileLookup", True).parquet(path)


def append_batch_once(path: str, writer: str):
    """A foreachBatch writer that stores each micro-batch in a folder of its own.

    `writer` names the query for good. Many writers share the table: a batch that is run again after a
    failure replaces only what the same writer stored for it, so every alert is stored once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*ALERTS.names).write.mode("overwrite").parquet(f"{path}/writer={writer}/batch_id={batch_id}")
    return write


def writer_of(kind: str, checkpoint: str) -> str:
    """A writer's name from its checkpoint, whose batch numbers it follows."""
    return f"{kind}-{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"


def alert_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Unbounded table of alerts as they arrive; a checkpoint remembers what was seen."""
    return (spark.readStream.schema(ALERTS).option("recursiveFileLookup", True).parquet(path))


def live_alert(scored: DataFrame) -> DataFrame:
    """Scored live events with prediction 1 as alert rows, payload kept as text."""
    return scored.filter(F.col("prediction") == 1).select(
        F.lit("stream").alias("source"), "merchant_id", F.current_timestamp().alias("detected_at"),
        F.lit(None).cast("timestamp").alias("window_start"),
        F.lit("Live Transaction Anomaly").alias("alert_type"),
        F.lit("Anomaly detected").alias("description"),
        F.col("decision").alias("anomaly_score"),
        F.lit(None).cast(ALERTS["metrics"].dataType).alias("metrics"),
        F.col("value").alias("payload_json"))
