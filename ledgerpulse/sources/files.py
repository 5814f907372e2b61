"""File readers and writers of the telemetry tables."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse import schemas

logger = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked from Spark's own file listing."""
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018  (resolves the path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder of files; a single file is listed under its own name."""
    files = spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
    return not files or files[0]["path"].rstrip("/").rsplit("/", 1)[-1] != path.rstrip("/").rsplit("/", 1)[-1]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header. Codes with leading digits stay strings by the schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As read_csv; a missing file gives an empty table of the same schema."""
    if path_exists(spark, path):
        return read_csv(spark, path, schema)
    logger.warning("CSV file not found: %s, using an empty table.", path)
    return spark.createDataFrame([], schema)


def load_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions CSV: must exist and hold the required columns; timestamps in UTC.

    Columns are matched by name, whatever their order; extra ones stay strings.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Transactions CSV not found at '{path}'.")
    raw = spark.read.option("header", True).csv(path)
    schemas.require_columns(raw, schemas.REQUIRED_TRANSACTION_COLUMNS, path)
    declared = {f.name: f.dataType for f in schemas.TRANSACTIONS.fields}
    return raw.select(*[
        F.to_timestamp(c).alias(c) if c == "timestamp" else F.col(c).cast(declared.get(c, T.StringType())).alias(c)
        for c in raw.columns])


class TelemetryTables:
    """The three tables, read from a folder or handed in."""

    def __init__(self, spark: SparkSession, data_dir: str | None = None, *, merchants: DataFrame | None = None,
                 transactions: DataFrame | None = None, webhook_logs: DataFrame | None = None) -> None:
        def given(frame, name, schema):
            if frame is not None:
                return frame
            if data_dir is None:
                return spark.createDataFrame([], schema)
            return read_csv_or_empty(spark, f"{data_dir}/{name}.csv", schema)
        self.merchants = given(merchants, "merchants", schemas.MERCHANTS)
        self.transactions = given(transactions, "transactions", schemas.TRANSACTIONS)
        self.webhook_logs = given(webhook_logs, "webhook_logs", schemas.WEBHOOK_LOGS)


def write_csv(df: DataFrame, path: str, internal: tuple[str, ...] = ("_anomaly_tag",)) -> None:
    """CSV with header, internal columns dropped and timestamps as text. Replaces the folder."""
    kept = df.drop(*internal)
    text = [F.date_format(f.name, "yyyy-MM-dd HH:mm:ss'+00:00'").alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
            for f in kept.schema.fields]
    kept.select(*text).write.mode("overwrite").option("header", True).csv(path)


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """All `*.md` files below a folder, one row per file: source, text."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"docs directory not found: '{folder}'.")
    docs = (spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))
    if docs.isEmpty():
        raise ValueError(f"No Markdown files found in '{folder}'.")
    return docs


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A stored table; FileNotFoundError if it was never written."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"table not found at '{path}'; build it first.")
    return spark.read.schema(schema).parquet(path)
