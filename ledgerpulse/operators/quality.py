"""Data-quality checks: one row per check with the number of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


STATUSES = ("SUCCESS", "DECLINED")
EVENT_TYPES = ("payment.success", "payment.failed", "payment.pending")


def _as_rows(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "check_name", "violations")


def _broken(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def duplicate_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows beyond the first of each key, from two combinable aggregates."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations")


def _transaction_rules(min_amount: float = 0.0) -> dict[str, Column]:
    """By check: whether a row breaks it; a null on which a rule cannot hold breaks it."""
    success, no_code = F.col("status") == "SUCCESS", F.col("decline_code").isNull()
    return {
        "status_domain": _broken(F.col("status").isin(*STATUSES)), "currency_domain": _broken(F.col("currency") == "INR"),
        "success_with_code": success & ~no_code, "decline_without_code": ~success & no_code,
        "amount_positive": _broken(F.col("amount") > min_amount), "amount_at_least_50": _broken(F.col("amount") >= 50)}


def _log_rules() -> dict[str, Column]:
    return {
        "event_type_domain": _broken(F.col("event_type").isin(*EVENT_TYPES)), "attempts_at_least_1": _broken(F.col("delivery_attempts") >= 1),
        "latency_positive": _broken(F.col("latency_ms") > 0)}


def _merchant_rules() -> dict[str, Column]:
    return {
        "merchant_id_format": _broken(F.col("merchant_id").rlike(r"^merchant_id_\d+$")),
        "webhook_url_https": _broken(F.col("webhook_url").startswith("https://"))}


def _counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return _as_rows(df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()]))


def transaction_checks(transactions: DataFrame, min_amount: float = 0.0) -> DataFrame:
    return _counted(transactions, _transaction_rules(min_amount))


def log_checks(logs: DataFrame) -> DataFrame:
    return _counted(logs, _log_rules())


def merchant_checks(merchants: DataFrame) -> DataFrame:
    return _counted(merchants, _merchant_rules())


def error_code_only_when_failed(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count_if((F.col("status") != "FAILED") & F.col("error_code").isNotNull()).alias("violations")
    ).select(F.lit("error_code_only_when_failed").alias("check_name"), "violations")


def log_per_transaction(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Transactions whose number of logs is not exactly one."""
    per_txn = logs.groupBy("transaction_id").agg(F.count("*").alias("n"))
    joined = transactions.select("transaction_id").join(per_txn, "transaction_id", "left")
    return joined.agg(F.count_if(F.coalesce("n", F.lit(0)) != 1).alias("violations")).select(
        F.lit("one_log_per_transaction").alias("check_name"), "violations")


def quality_report(merchants: DataFrame, transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """All checks with one scan per table and one shuffle.

    Every row gives a record for each key it has, the first with the rules it breaks. One aggregation by key counts rows, logs
    and broken rules; it is combined on the map side, so a key with very many rows sends one record per task.
    """
    tables = {
        "merchant_id": (merchants, _merchant_rules(), ["merchant_id"]), "transaction_id": (transactions, _transaction_rules(), ["transaction_id"]),
        "log_id": (logs, _log_rules(), ["log_id", "transaction_id"])}
    names = [name for _, rules, _ in tables.values() for name in rules]
    records = None
    for own, (table, rules, keys) in tables.items():
        entries = F.array(*[
            F.struct(F.lit(key).alias("kind"), F.col(key).cast("string").alias("key"), F.lit(int(key == own)).alias("rows"), F.lit(int(key != own)).alias("logs"),
                     *[(rules[n] if n in rules and key == own else F.lit(False)).cast("int").alias(n) for n in names])
            for key in keys])
        part = table.select(F.inline(entries))
        records = part if records is None else records.unionByName(part)
    by_key = (records.filter("rows = 1 or key is not null").groupBy("kind", "key")
              .agg(*[F.sum(c).alias(c) for c in ("rows", "logs", *names)]))
    none = F.lit(0)
    spare = {key: F.coalesce(F.sum(F.when(F.col("kind") == key, F.greatest(F.col("rows") - 1, none))), none) for key in tables}
    return _as_rows(by_key.agg(
        *[spare[key].alias(f"duplicate_{key}") for key in tables], *[F.coalesce(F.sum(n), none).alias(n) for n in names],
        F.coalesce(F.sum(F.when((F.col("kind") == "transaction_id") & (F.col("logs") != 1), F.col("rows"))), none).alias("one_log_per_transaction")))
