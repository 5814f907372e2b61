"""Dashboard figures and merchant diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import RISK_BLOCK_CODE, is_delivered, is_failed, safe_pct
from ledgerpulse.operators.joins import transactions_with_logs
from ledgerpulse.operators.quantiles import exact_quantiles
from ledgerpulse.operators.ranking import by_frequency, recent_logs_all, recent_transactions_all


def _success():
    return F.col("status") == "SUCCESS"


def success_counts(transactions: DataFrame, *by: str) -> DataFrame:
    """Totals with successes and all other outcomes."""
    return transactions.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(_success()).alias("success_count"),
        (F.count("*") - F.count_if(_success())).alias("non_success_count"))


def success_rate(transactions: DataFrame, *by: str) -> DataFrame:
    return (success_counts(transactions, *by)
            .select(*by, "total", "success_count", safe_pct("success_count", "total").alias("success_rate")))


def webhook_success_rate(logs: DataFrame) -> DataFrame:
    return (logs.agg(F.count("*").alias("total"), F.count_if(is_delivered("http_status")).alias("delivered"))
            .select("total", "delivered", safe_pct("delivered", "total").alias("webhook_success_rate")))


def critical_failures(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Risk blocks plus HTTP 500 deliveries; a row with both counts twice."""
    risk = F.count_if(F.col("decline_code") == RISK_BLOCK_CODE)
    crashed = F.count_if(F.col("http_status") == 500)
    return transactions_with_logs(transactions, logs).agg(
        risk.alias("risk_blocks"), crashed.alias("http_500"), (risk + crashed).alias("critical_failures"))


def failed_transactions(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    return transactions_with_logs(transactions, logs).filter(is_failed())


def decline_code_frequency(transactions: DataFrame) -> DataFrame:
    coded = transactions.filter(F.col("decline_code").isNotNull() & (F.col("decline_code") != ""))
    return by_frequency(coded.groupBy("decline_code").agg(F.count("*").alias("n")), "decline_code")


def decline_distribution(transactions: DataFrame) -> DataFrame:
    """Code frequency among rows that did not succeed."""
    failed = transactions.filter((F.col("status") != "SUCCESS") & F.col("decline_code").isNotNull())
    return by_frequency(failed.groupBy("decline_code").agg(F.count("*").alias("n")), "decline_code")


def http_status_frequency(logs: DataFrame) -> DataFrame:
    counts = logs.filter(F.col("http_status").isNotNull()).groupBy("http_status").agg(F.count("*").alias("n"))
    return by_frequency(counts, "http_status")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return by_frequency(df.groupBy(column).agg(F.count("*").alias("n")), column)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Number of distinct values of each column, one row per column; the table is read once."""
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "distinct_values")


def table_summary(transactions: DataFrame) -> DataFrame:
    """Row count, outcome shares and amount range with the exact median."""
    median = exact_quantiles(transactions, "amount", [0.5])[0]
    return transactions.agg(
        F.count("*").alias("row_count"),
        F.avg(_success().cast("double")).alias("success_share"),
        F.avg((F.col("status") == "DECLINED").cast("double")).alias("declined_share"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.lit(median).cast("double").alias("median_amount"))


def volume_concentration(transactions: DataFrame) -> DataFrame:
    """How unevenly transactions spread over merchants."""
    counts = transactions.groupBy("merchant_id").agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("merchants"),
        F.max("n").alias("top_count"),
        F.min("n").alias("bottom_count"),
        (F.max("n") / F.min("n")).alias("top_bottom_ratio"),
        F.stddev_samp("n").alias("count_stddev"))


def hour_counts(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(F.hour("timestamp").alias("hour_utc")).agg(F.count("*").alias("n"))


def hourly_profile(transactions: DataFrame, peak=(5, 9), off_peak=(20, 23)) -> DataFrame:
    """Peak and off-peak volume, and the spread of the hourly counts."""
    hours = hour_counts(transactions)
    def within(bounds):
        return F.sum(F.when(F.col("hour_utc").between(*bounds), F.col("n")).otherwise(0))
    return hours.agg(
        F.sum("n").alias("total"), within(peak).alias("peak_count"), within(off_peak).alias("off_peak_count"),
        F.stddev_samp("n").alias("hour_stddev"))


def burst_span(transactions: DataFrame, *by: str) -> DataFrame:
    """Seconds between first and last row of each group."""
    def seconds(c):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    return (transactions.groupBy(*by)
            .agg(F.count("*").alias("n"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"))
            .withColumn("span_seconds", seconds(F.col("last_at")) - seconds(F.col("first_at"))))


# ---- merchant diagnostics --------------------------------------------------

def _newest(value) -> Column:
    """(rank, value) pairs of one merchant's newest rows, in order of rank; nulls left out."""
    return F.sort_array(F.collect_list(F.when(value.isNotNull() & (value != ""), F.struct("rank", value.alias("value")))))


def _frequency_text(pairs: str, before: str, after: str) -> Column:
    """Lines by falling count, then by recency; null if there is nothing to count."""
    values = F.array_distinct(F.transform(pairs, lambda p: p["value"]))
    def entry(value):
        same = F.filter(pairs, lambda p: p["value"] == value)
        return F.struct((-F.size(same)).alias("order_n"), same[0]["rank"].alias("seen"), value.alias("value"))
    lines = F.transform(F.sort_array(F.transform(values, entry)), lambda e: F.concat(
        F.lit(before), e["value"], F.lit(": "), (-e["order_n"]).cast("string"), F.lit(after)))
    return F.when(F.size(pairs) > 0, F.array_join(lines, "\n"))


def merchant_diagnostics(merchants: DataFrame, transactions: DataFrame, logs: DataFrame,
                         inspected: int = 50, shown: int = 5) -> DataFrame:
    """A report for every merchant over its newest transactions and logs.

    Each table is ranked and summed up once. What is gathered per merchant is
    at most the `inspected` newest rows.
    """
    txns = recent_transactions_all(transactions, inspected).groupBy("merchant_id").agg(
        F.count("*").alias("total"), F.count_if(_success()).alias("success_count"),
        _newest(F.col("decline_code")).alias("codes"))
    line = F.concat(F.lit("  • log_id="), F.col("log_id"), F.lit("  http_status="), F.col("http_status").cast("string"),
                    F.lit("  event_type="), F.col("event_type"))
    deliveries = recent_logs_all(transactions, logs, inspected).groupBy("merchant_id").agg(
        F.count("*").alias("log_total"), _newest(F.col("http_status").cast("string")).alias("statuses"),
        F.sort_array(F.collect_list(F.when(F.col("rank") <= shown, F.struct("rank", line.alias("line"))))).alias("recent"))
    joined = (merchants.select("merchant_id").join(txns, "merchant_id", "left")
              .join(deliveries, "merchant_id", "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    failed = zero("total") - zero("success_count")
    code_lines = _frequency_text("codes", "  • ", " occurrences")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Diagnostic report for "), F.col("merchant_id"), F.lit(" (last "), zero("total").cast("string"),
                 F.lit(" transactions, last "), zero("log_total").cast("string"), F.lit(" webhook logs):")),
        F.lit(""),
        F.concat(F.lit("Transaction breakdown: "), zero("success_count").cast("string"), F.lit(" SUCCESS, "),
                 failed.cast("string"), F.lit(" DECLINED.")),
        F.coalesce(F.concat(F.lit("Decline code frequency:\n"), code_lines),
                   F.lit("No decline codes recorded in this window.")),
        F.lit(""),
        F.lit("Webhook HTTP status frequency:"),
        F.coalesce(_frequency_text("statuses", "  • HTTP ", " deliveries"), F.lit("  (no webhook logs found)")),
        F.lit(""),
        F.lit("Most-recent webhook log entries (for retry reference):"),
        F.when(F.size("recent") > 0, F.array_join(F.transform("recent", lambda r: r["line"]), "\n")).otherwise(F.lit("  (none)")))
    return joined.select(
        "merchant_id", zero("total").alias("total"), zero("success_count").alias("success_count"),
        failed.alias("non_success_count"), zero("log_total").alias("log_total"), text.alias("report"))
