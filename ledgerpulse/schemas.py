"""Explicit schemas of the telemetry tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.StringType()),
    T.StructField("business_name", T.StringType()),
    T.StructField("mcc_code", T.StringType()),
    T.StructField("webhook_url", T.StringType()),
])

MERCHANT_PROFILE = T.StructType(MERCHANTS.fields + [
    T.StructField("hourly_profile", T.StringType()),
    T.StructField("yearly_profile", T.StringType()),
    T.StructField("is_random_pattern", T.BooleanType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("decline_code", T.StringType()),
    T.StructField("card_bin", T.StringType()),
])

WEBHOOK_LOGS = T.StructType([
    T.StructField("log_id", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("delivery_attempts", T.IntegerType()),
    T.StructField("latency_ms", T.IntegerType()),
])

LIVE_EVENT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("decline_code", T.StringType()),
    T.StructField("webhook_http_status", T.IntegerType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("anomaly_type", T.StringType()),
])

INGEST_EVENT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

ALERTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("detected_at", T.TimestampType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("alert_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("metrics", T.StructType([
        T.StructField("decline_ratio", T.DoubleType()),
        T.StructField("total_transactions", T.LongType()),
    ])),
    T.StructField("payload_json", T.StringType()),
])

REQUIRED_TRANSACTION_COLUMNS = ("transaction_id", "merchant_id", "timestamp", "amount", "status")

WINDOW_FEATURES = (
    "total_transactions", "decline_count", "decline_ratio", "avg_amount", "risk_block_count",
)
REDUCED_FEATURES = ("total_transactions", "decline_count", "decline_ratio", "avg_amount")
LIVE_FEATURES = (
    "amount", "is_declined", "is_risk_block", "is_webhook_401", "is_webhook_error", "hour_of_day",
)
COMPARISON_FEATURES = ("amount", "http_status", "delivery_attempts")


def require_columns(df: DataFrame, names, what: str = "table") -> DataFrame:
    """Raise ValueError naming the columns that are absent; else return df."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
