"""Joins of transactions, delivery logs, merchants and reference knowledge.

No join here carries a broadcast hint on a table that grows. Spark broadcasts
a side by its own size check, adaptive execution does so from measured
sizes, and splits the partitions of a hot key where it may: either side of an
inner join, the left side of a left, semi or anti join. Right sides are
therefore reduced to distinct keys or one row per key first, or joined by
`left_join_any_keys`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import decline_code_number
from ledgerpulse.functions.knowledge import decline_knowledge, webhook_knowledge
from ledgerpulse.operators.lookups import first_per_key
from ledgerpulse.operators.sets import key_sides

def left_join_any_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join for a right side with any number of rows per key.

    Adaptive execution splits a hot key on either side of an inner join, but not on the right
    side of a left join. So matches come from an inner join, and left rows without a match
    from an anti join with the distinct keys, which are combined on the map side.
    """
    matched = left.join(right, key)
    alone = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def transactions_with_logs(transactions: DataFrame, logs: DataFrame, one_log_each: bool = False) -> DataFrame:
    """Left join on transaction_id; columns of both sides get `_wh` on the log side.

    `one_log_each` states that no transaction has more than a few logs; then a plain left join is enough.
    """
    renamed = logs.select(*[
        F.col(c).alias(f"{c}_wh") if c in transactions.columns and c != "transaction_id" else F.col(c)
        for c in logs.columns])
    if one_log_each:
        return transactions.join(renamed, "transaction_id", "left")
    return left_join_any_keys(transactions, renamed, "transaction_id")


def merged_view(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """The left join, but an empty side returns the other side unchanged."""
    if transactions.isEmpty():
        return logs
    if logs.isEmpty():
        return transactions
    return transactions_with_logs(transactions, logs)


def logs_of_merchant(transactions: DataFrame, logs: DataFrame, merchant_id: str) -> DataFrame:
    own = transactions.filter(F.col("merchant_id") == merchant_id).select("transaction_id")
    return logs.join(own, "transaction_id", "left_semi")


def logs_with_merchant(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Every log with its merchant; logs without a transaction are left out.

    The join key is the transaction, so a large merchant is still spread over
    all partitions.
    """
    owner = transactions.select("transaction_id", "merchant_id")
    return logs.join(owner, "transaction_id", "inner")


def transaction_details(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Each transaction with its first log as a struct, null if there is none."""
    first = first_per_key(logs, "transaction_id", "log_id")
    packed = first.select("transaction_id", F.struct(*logs.columns).alias("webhook_log"))
    return transactions.join(packed, "transaction_id", "left")


def with_merchant_columns(transactions: DataFrame, merchants: DataFrame, *columns: str) -> DataFrame:
    """Dimension lookup on merchant_id."""
    return transactions.join(merchants.select("merchant_id", *columns), "merchant_id", "left")


def decline_explanations(transactions: DataFrame) -> DataFrame:
    """Declined transactions with title and meaning of their code.

    The knowledge side has seven rows by construction, hence the hint.
    """
    knowledge = F.broadcast(decline_knowledge(transactions.sparkSession))
    coded = transactions.filter(F.col("decline_code").isNotNull())
    return coded.join(knowledge, decline_code_number("decline_code") == F.col("code"), "left")


def delivery_explanations(logs: DataFrame) -> DataFrame:
    """Logs with what their HTTP status means and what the gateway does; the knowledge side has nine rows."""
    return logs.join(F.broadcast(webhook_knowledge(logs.sparkSession)), "http_status", "left")


def orphan_counts(transactions: DataFrame, logs: DataFrame, merchants: DataFrame) -> DataFrame:
    """Keys without a partner, one row per direction."""
    def missing(left, right, key, left_name, right_name):
        alone = key_sides(left, right, key).agg(
            F.count_if(~F.col("in_right")).alias(f"{left_name}_without_{right_name}"),
            F.count_if(~F.col("in_left")).alias(f"{right_name}_without_{left_name}"))
        return alone.unpivot([], alone.columns, "check_name", "orphans")
    return (missing(transactions, logs, "transaction_id", "txn", "log")
            .unionAll(missing(transactions, merchants, "merchant_id", "txn", "merchant")))
