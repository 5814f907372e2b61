"""Rule detectors for known failure patterns, for all merchants or BINs at once.

Each detector filters first and then groups with combinable aggregates, so a
merchant or BIN holding most rows only sends partial sums through the shuffle.
Defaults are the volumes of the documented incidents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import (
    CARD_TEST_CODES, ISSUER_DOWN_CODE, RISK_BLOCK_CODE, is_failed, next_steps, remediation, safe_divide,
)
from ledgerpulse.operators.joins import logs_with_merchant, transactions_with_logs
from ledgerpulse.operators.lookups import retry_successes
from ledgerpulse.operators.quantiles import order_statistics
from ledgerpulse.operators.ranking import first_matching


def _window(grouped: DataFrame, *columns: str) -> DataFrame:
    return grouped.withColumn("window_start", F.col("window.start")).select(*columns)


def risk_block_spikes(transactions: DataFrame, window: str = "10 minutes", at_least: int = 50) -> DataFrame:
    hits = transactions.filter((F.col("status") == "DECLINED") & (F.col("decline_code") == RISK_BLOCK_CODE))
    found = (hits.groupBy("merchant_id", F.window("timestamp", window))
             .agg(F.count("*").alias("risk_blocks")).filter(F.col("risk_blocks") >= at_least))
    return _window(found, "merchant_id", "window_start", "risk_blocks")


def auth_failures(transactions: DataFrame, logs: DataFrame, window: str = "2 hours",
                  min_share: float = 1.0, at_least: int = 10) -> DataFrame:
    """Merchants whose deliveries in a window are (nearly) all 401."""
    found = (logs_with_merchant(transactions, logs)
             .groupBy("merchant_id", F.window("timestamp", window))
             .agg(F.count("*").alias("logs"), F.count_if(F.col("http_status") == 401).alias("unauthorized"))
             .withColumn("unauthorized_share", safe_divide("unauthorized", "logs"))
             .filter((F.col("logs") >= at_least) & (F.col("unauthorized_share") >= min_share)))
    return _window(found, "merchant_id", "window_start", "logs", "unauthorized", "unauthorized_share")


def card_testing(transactions: DataFrame, window: str = "5 minutes", low: float = 1.0, high: float = 5.0,
                 at_least: int = 100, min_declined: float = 0.9, min_test_codes: float = 0.9) -> DataFrame:
    """Bursts of tiny amounts, nearly all declined with card-probing codes."""
    found = (transactions.filter(F.col("amount").between(low, high))
             .groupBy("merchant_id", F.window("timestamp", window))
             .agg(F.count("*").alias("small_txns"),
                  F.count_if(F.col("status") == "DECLINED").alias("declined"),
                  F.count_if(F.col("decline_code").isin(*CARD_TEST_CODES)).alias("test_codes"))
             .withColumn("declined_share", safe_divide("declined", "small_txns"))
             .withColumn("test_code_share", safe_divide("test_codes", "declined"))
             .filter((F.col("small_txns") >= at_least) & (F.col("declined_share") >= min_declined)
                     & (F.col("test_code_share") >= min_test_codes)))
    return _window(found, "merchant_id", "window_start", "small_txns", "declined_share", "test_code_share")


def issuer_outages(transactions: DataFrame, window: str = "2 hours", at_least: int = 20,
                   min_share: float = 0.9) -> DataFrame:
    """BINs that fail at every merchant because the issuer is down."""
    found = (transactions.filter(F.col("card_bin").isNotNull())
             .groupBy("card_bin", F.window("timestamp", window))
             .agg(F.count("*").alias("txns"), F.count_if(F.col("decline_code") == ISSUER_DOWN_CODE).alias("issuer_down"))
             .withColumn("issuer_down_share", safe_divide("issuer_down", "txns"))
             .filter((F.col("txns") >= at_least) & (F.col("issuer_down_share") >= min_share)))
    return _window(found, "card_bin", "window_start", "txns", "issuer_down", "issuer_down_share")


def overloads(transactions: DataFrame, logs: DataFrame, window: str = "1 hour", volume_factor: float = 2.0,
              min_overload_share: float = 0.5, at_least: int = 1, slow_ms: int = 5000) -> DataFrame:
    """Windows with volume above the merchant's mean and timed-out, slow deliveries."""
    overload = (F.col("http_status") == 504) & (F.col("latency_ms") > slow_ms)
    # One row per transaction on both sides, so no key is hot; the transaction's own window decides.
    joined = transactions_with_logs(
        transactions.select("transaction_id", "merchant_id", "timestamp"),
        logs.groupBy("transaction_id").agg(
            F.count("*").alias("log_count"), F.count_if(overload).alias("overload_count")), one_log_each=True)
    volume = (joined.groupBy("merchant_id", F.window("timestamp", window))
              .agg(F.count("*").alias("txns"),
                   F.sum(F.coalesce("log_count", F.lit(0))).alias("logs"),
                   F.sum(F.coalesce("overload_count", F.lit(0))).alias("overloaded")))
    # one row per merchant and window by now, so a merchant's group is bounded by the time span
    mean = F.avg("txns").over(Window.partitionBy("merchant_id"))
    found = (volume.withColumn("mean_txns", mean)
             .withColumn("overload_share", safe_divide("overloaded", "logs"))
             .filter((F.col("txns") >= F.col("mean_txns") * volume_factor) & (F.col("overloaded") >= at_least)
                     & (F.col("overload_share") >= min_overload_share)))
    return _window(found, "merchant_id", "window_start", "txns", "mean_txns", "overloaded", "overload_share")


def reconciliation_gaps(transactions: DataFrame, logs: DataFrame, attempts: int = 3) -> DataFrame:
    """Charged but never notified: success whose delivery crashed on every attempt."""
    dropped = logs.filter((F.col("http_status") == 500) & (F.col("delivery_attempts") >= attempts))
    paid = transactions.filter(F.col("status") == "SUCCESS")
    return paid.join(dropped.select("transaction_id", "log_id", "http_status", "delivery_attempts"), "transaction_id")


def remediation_classes(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """What to do about each delivery log."""
    known = logs.join(transactions.select("transaction_id", "merchant_id", "status"), "transaction_id", "left")
    return known.select("log_id", "transaction_id", "merchant_id", "http_status",
                        remediation().alias("remediation"))


def retryable_logs(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    return remediation_classes(transactions, logs).filter(F.col("remediation") == "RETRY").select("log_id")


def bulk_retry(transactions: DataFrame, logs: DataFrame, new_status: int = 200) -> DataFrame:
    """Logs after every retryable delivery was sent again; the logs tell themselves, so one join is enough."""
    known = logs.join(transactions.select("transaction_id", "status"), "transaction_id", "left")
    sent = F.when(remediation() == "RETRY", F.lit(new_status)).otherwise(F.col("http_status"))
    return known.withColumn("http_status", sent).select(*logs.columns)


def bulk_retry_outcomes(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Every retryable log comes from `logs`, so each one is found."""
    return retry_successes(retryable_logs(transactions, logs))


def triage(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Next steps of every transaction that needs attention."""
    joined = transactions_with_logs(transactions, logs)
    return (joined.filter(is_failed())
            .select("transaction_id", "merchant_id", "log_id", F.array_join(next_steps(), ">").alias("steps")))


def sample_order(identifier: str = "transaction_id") -> Column:
    """A fixed pseudo-random order of ids, without nulls.

    An odd multiplier permutes the last number of the id modulo 2^33; ids without a number, or with one too
    long, go by a hash. The multiplication is done in two halves, so it cannot overflow, and ids that meet
    in one place are told apart by a hash of the whole id.
    """
    size, factor, half = F.lit(8589934592), F.lit(1103515245), F.lit(65536)
    number = F.pmod(F.coalesce(F.regexp_extract(identifier, r"(\d+)$", 1).try_cast("bigint"), F.xxhash64(identifier)), size)
    high, low = F.floor(number / half).cast("bigint"), F.pmod(number, half)
    place = F.pmod(F.pmod(high * factor, size) * half + low * factor, size)
    return place * F.lit(1 << 20) + F.pmod(F.xxhash64(identifier), F.lit(1 << 20))  # below 2^53, exact as a double


def tag_first(transactions: DataFrame, condition: Column, cap: int, tag: str, per: str | None = None,
              status: str | None = None, decline_code: str | None = None, overwrite: bool = False) -> DataFrame:
    """Tag (and optionally decline) the first `cap` rows that meet the condition.

    At most `cap` rows per key are selected before the join.
    """
    chosen = first_matching(transactions, condition, cap, per).select("transaction_id", F.lit(True).alias("_hit"))
    hit = F.coalesce("_hit", F.lit(False))
    return _apply(transactions.join(chosen, "transaction_id", "left"), hit, tag, status, decline_code, overwrite).drop("_hit")


def tag_share(transactions: DataFrame, condition: Column, share: float, tag: str,
              status: str | None = None, decline_code: str | None = None) -> DataFrame:
    """Tag exactly ceil(share * n) of the n matching rows, chosen without replacement.

    The cut is the order statistic of a fixed pseudo-random order, found by
    histogram passes; no row is ranked in one task and nothing is joined.
    """
    order = sample_order()
    hits = transactions.filter(condition)
    total = hits.count()
    if not total:
        return _apply(transactions, F.lit(False), tag, status, decline_code, False)
    cut = order_statistics(hits, order, [math.ceil(total * share) - 1])[0]
    return _apply(transactions, F.coalesce(condition, F.lit(False)) & (order <= F.lit(int(cut))),
                  tag, status, decline_code, False)


def _apply(df: DataFrame, hit: Column, tag, status, decline_code, overwrite) -> DataFrame:
    current = F.col("_anomaly_tag") if "_anomaly_tag" in df.columns else F.lit(None).cast("string")
    free = hit if overwrite else hit & current.isNull()
    changes = {"_anomaly_tag": F.when(free, F.lit(tag)).otherwise(current)}
    if status:
        changes["status"] = F.when(hit, F.lit(status)).otherwise(F.col("status"))
    if decline_code:
        changes["decline_code"] = F.when(hit, F.lit(decline_code)).otherwise(F.col("decline_code"))
    return df.withColumns(changes)
