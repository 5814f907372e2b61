"""Bursts that do not keep to the clock: totals over a window that ends at any second.

Events are first summed per key and second, so a key that holds most rows sends at most one row per second and map task.
Seconds are dealt to (key, bucket) groups, a bucket being some windows long; those of the last window before a bucket's
end also go to the next bucket as a halo. Every second enters a group's running total with its numbers and leaves it one
window later with their negatives, so a window's total is the running one: one step per row, however many seconds a window
has. No group has more than two rows for each second of a bucket and a window, and a hot key is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import CARD_TEST_CODES, ISSUER_DOWN_CODE, RISK_BLOCK_CODE, safe_divide
from ledgerpulse.operators.joins import logs_with_merchant, transactions_with_logs

#: Windows in a bucket.
BUCKET_WINDOWS = 8
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def window_seconds(window: str) -> int:
    """Seconds of a duration such as "10 minutes"."""
    number, unit = window.split()
    seconds = int(number) * _UNITS[unit.lower().removesuffix("s")]
    if seconds < 1:
        raise ValueError(f"not a window: {window}")
    return seconds


def sliding_totals(events: DataFrame, key: str, sums: dict[str, Column], window: str) -> DataFrame:
    """(key, at, sums): totals of the seconds in (at - window, at], for every second `at` (since 1970) in which the key has an event.

    `sums` are numbers per event. Events without key or timestamp are left out.
    """
    width = window_seconds(window)
    span = width * BUCKET_WINDOWS
    at = F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / 1_000_000)
    seconds = (events.filter(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
               .groupBy(key, at.alias("at")).agg(*[F.sum(value.cast("bigint")).alias(name) for name, value in sums.items()]))
    bucket = F.floor(F.col("at") / span)
    reaches_next = F.col("at") + width - 1 >= (bucket + 1) * span
    dealt = seconds.withColumn("halo", F.explode(F.when(reaches_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).withColumn(
        "bucket", bucket + F.col("halo"))
    # a frame that moves would be summed anew for every row; whole numbers leave no remainder
    come = F.struct(F.col("at"), (F.col("halo") == 0).alias("asked"), *sums)
    go = F.struct((F.col("at") + width).alias("at"), F.lit(False).alias("asked"), *[(-F.col(name)).alias(name) for name in sums])
    moves = dealt.select(key, "bucket", F.inline(F.array(come, go)))
    frame = Window.partitionBy(key, "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return moves.select(key, "at", "asked", *[F.sum(name).over(frame).alias(name) for name in sums]).filter("asked").drop("asked")


def bursts(totals: DataFrame, key: str, condition: Column, window: str, peaks: list[str]) -> DataFrame:
    """Overlapping windows that meet the condition, as one row: key, burst_start, burst_end, windows, peak_<name>.

    The burst lasts from the first second of its first window to the last second of its last one.
    """
    width = window_seconds(window)
    found = totals.filter(condition).withColumn("moment", F.timestamp_seconds("at"))
    return (found.groupBy(key, F.session_window("moment", f"{width} seconds"))
            .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("windows"), *[F.max(p).alias(f"peak_{p}") for p in peaks])
            .select(key, F.timestamp_seconds(F.col("first") - (width - 1)).alias("burst_start"), F.timestamp_seconds("last").alias("burst_end"),
                    "windows", *[f"peak_{p}" for p in peaks]))


def _one(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def risk_block_bursts(transactions: DataFrame, window: str = "10 minutes", at_least: int = 50) -> DataFrame:
    hits = transactions.filter((F.col("status") == "DECLINED") & (F.col("decline_code") == RISK_BLOCK_CODE))
    totals = sliding_totals(hits, "merchant_id", {"risk_blocks": F.lit(1)}, window)
    return bursts(totals, "merchant_id", F.col("risk_blocks") >= at_least, window, ["risk_blocks"])


def auth_failure_bursts(transactions: DataFrame, logs: DataFrame, window: str = "2 hours", min_share: float = 1.0, at_least: int = 10) -> DataFrame:
    """Merchants whose deliveries are (nearly) all 401 over any stretch as long as the window."""
    totals = sliding_totals(logs_with_merchant(transactions, logs), "merchant_id",
                            {"logs": F.lit(1), "unauthorized": _one(F.col("http_status") == 401)}, window)
    return bursts(totals, "merchant_id", (F.col("logs") >= at_least) & (safe_divide("unauthorized", "logs") >= min_share), window, ["unauthorized"])


def card_testing_bursts(transactions: DataFrame, window: str = "5 minutes", low: float = 1.0, high: float = 5.0, at_least: int = 100,
                        min_declined: float = 0.9, min_test_codes: float = 0.9) -> DataFrame:
    """Tiny amounts, nearly all declined with card-probing codes, over any stretch as long as the window."""
    totals = sliding_totals(transactions.filter(F.col("amount").between(low, high)), "merchant_id", {
        "small_txns": F.lit(1), "declined": _one(F.col("status") == "DECLINED"),
        "test_codes": _one(F.col("decline_code").isin(*CARD_TEST_CODES))}, window)
    condition = ((F.col("small_txns") >= at_least) & (safe_divide("declined", "small_txns") >= min_declined)
                 & (safe_divide("test_codes", "declined") >= min_test_codes))
    return bursts(totals, "merchant_id", condition, window, ["small_txns", "test_codes"])


def issuer_outage_bursts(transactions: DataFrame, window: str = "2 hours", at_least: int = 20, min_share: float = 0.9) -> DataFrame:
    """BINs that fail at every merchant because the issuer is down."""
    totals = sliding_totals(transactions, "card_bin", {"txns": F.lit(1), "issuer_down": _one(F.col("decline_code") == ISSUER_DOWN_CODE)}, window)
    return bursts(totals, "card_bin", (F.col("txns") >= at_least) & (safe_divide("issuer_down", "txns") >= min_share), window, ["issuer_down"])


def overload_bursts(transactions: DataFrame, logs: DataFrame, window: str = "1 hour", volume_factor: float = 2.0,
                    min_overload_share: float = 0.5, at_least: int = 1, slow_ms: int = 5000) -> DataFrame:
    """Stretches with volume above the merchant's mean and timed-out, slow deliveries.

    The mean is that of the clock's windows in which the merchant has transactions.
    """
    overload = (F.col("http_status") == 504) & (F.col("latency_ms") > slow_ms)
    joined = transactions_with_logs(
        transactions.select("transaction_id", "merchant_id", "timestamp"),
        logs.groupBy("transaction_id").agg(
            F.count("*").alias("log_count"), F.count_if(overload).alias("overload_count")), one_log_each=True)
    totals = sliding_totals(joined, "merchant_id", {
        "txns": F.lit(1), "logs": F.coalesce("log_count", F.lit(0)), "overloaded": F.coalesce("overload_count", F.lit(0))}, window)
    # a mean needs only how many windows there are: one row per merchant and window
    means = (transactions.groupBy("merchant_id", F.window("timestamp", window)).agg(F.count("*").alias("n"))
             .groupBy("merchant_id").agg(F.avg("n").alias("mean_txns")))
    condition = ((F.col("txns") >= F.col("mean_txns") * volume_factor) & (F.col("overloaded") >= at_least)
                 & (safe_divide("overloaded", "logs") >= min_overload_share))
    return bursts(totals.join(means, "merchant_id"), "merchant_id", condition, window, ["txns", "overloaded"])
