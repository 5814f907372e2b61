"""Windowed merchant features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import RISK_BLOCK_CODE, safe_divide
from ledgerpulse.operators.lookups import with_defaults
from ledgerpulse.schemas import REDUCED_FEATURES, WINDOW_FEATURES

DEFAULT_WINDOW = "10 minutes"


def window_aggregates():
    """The aggregates of one (merchant, window) group; all combine on the map side."""
    return [
        F.count("transaction_id").alias("total_transactions"),
        F.count_if(F.col("status") == "DECLINED").alias("decline_count"),
        F.avg("amount").alias("avg_amount"),
        F.count_if(F.col("decline_code") == RISK_BLOCK_CODE).alias("risk_block_count"),
    ]


def finish_features(grouped: DataFrame) -> DataFrame:
    """Window groups to feature rows: ratio added, empty windows left out."""
    return (grouped.filter(F.col("total_transactions") > 0)
            .withColumn("decline_ratio", safe_divide("decline_count", "total_transactions"))
            .select("merchant_id", F.col("window.start").alias("timestamp"), *WINDOW_FEATURES))


def window_features(transactions: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """One row per merchant and tumbling window that holds a transaction.

    `window` should divide a day; windows count from midnight UTC. Rows with a
    null merchant or timestamp belong to no group.
    """
    source = with_defaults(transactions, {"decline_code": ""})
    if dict(source.dtypes)["timestamp"] == "string":
        source = source.withColumn("timestamp", F.to_timestamp("timestamp"))
    grouped = (source.filter(F.col("merchant_id").isNotNull() & F.col("timestamp").isNotNull())
               .groupBy("merchant_id", F.window("timestamp", window))
               .agg(*window_aggregates()))
    return finish_features(grouped)


def reduced_features(transactions: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """The variant without window start and risk-block count."""
    return window_features(transactions, window).select("merchant_id", *REDUCED_FEATURES)
