"""Newest-N, first-N and sequence numbers.

Per-key ranks are always cut to n rows, so Spark drops all but n rows per key
in each map task before the shuffle; a hot key costs n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.operators.joins import logs_of_merchant, logs_with_merchant
from ledgerpulse.operators.lookups import DEFAULT_LIMIT, checked_limit
from ledgerpulse.session import cut_lineage


def top_n_per_key(df: DataFrame, keys, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    placed = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, placed).filter(F.col(rank) <= n)


def recent_transactions(transactions: DataFrame, merchant_id: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    own = transactions.filter(F.col("merchant_id") == merchant_id)
    return own.orderBy(F.desc("timestamp"), "transaction_id").limit(checked_limit(limit))


def recent_transactions_all(transactions: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return top_n_per_key(transactions, "merchant_id", [F.desc("timestamp"), F.asc("transaction_id")],
                         checked_limit(limit))


def recent_logs(transactions: DataFrame, logs: DataFrame, merchant_id: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    own = logs_of_merchant(transactions, logs, merchant_id)
    return own.orderBy(F.desc("timestamp"), "log_id").limit(checked_limit(limit))


def recent_logs_all(transactions: DataFrame, logs: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return top_n_per_key(logs_with_merchant(transactions, logs), "merchant_id",
                         [F.desc("timestamp"), F.asc("log_id")], checked_limit(limit))


def retry_candidates_preview(transactions: DataFrame, logs: DataFrame, n: int = 5) -> DataFrame:
    """The newest logs of each merchant, as shown for picking a retry."""
    return recent_logs_all(transactions, logs, n).select(
        "merchant_id", "rank", "log_id", "http_status", "event_type")


def first_matching(df: DataFrame, condition: Column, n: int, per: str | None = None) -> DataFrame:
    """First n rows that meet the condition, in time order, overall or per key."""
    hits = df.filter(condition)
    order = [F.asc("timestamp"), F.asc("transaction_id")]
    if per is None:
        return hits.orderBy(*order).limit(n)
    return top_n_per_key(hits, per, order, n)


def by_frequency(counts: DataFrame, key: str, count: str = "n") -> DataFrame:
    return counts.orderBy(F.desc(count), F.asc(key))


def sequential_ids(df: DataFrame, order: list[str], name: str = "transaction_id",
                   prefix: str = "TXN-", start: int = 0) -> DataFrame:
    """Rows numbered from `start` in the given order, as padded ids.

    The sort is range-partitioned and stored once, so both passes see the same
    partitions. Each partition then only needs the row count before it; the
    table of counts has one row per partition.
    """
    from ledgerpulse.functions.expressions import padded_id

    ordered = cut_lineage(df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_pos")))
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_size"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_pos") - F.col("_first") + F.lit(start)
    return (ordered.join(F.broadcast(offsets), "_part")
            .withColumn(name, padded_id(prefix, number))
            .drop("_part", "_pos", "_first", "_offset", "_size"))
