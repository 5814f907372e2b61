"""Point and batch lookups, existence checks, conditional update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse.functions.expressions import nan_to_null

MIN_LIMIT, MAX_LIMIT, DEFAULT_LIMIT = 1, 500, 10


def checked_limit(limit: int = DEFAULT_LIMIT) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not MIN_LIMIT <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be an integer from {MIN_LIMIT} to {MAX_LIMIT}, got {limit!r}")
    return limit


def find_by_key(table: DataFrame, key: str, value: str) -> DataFrame:
    """At most one row; empty for an unknown or empty key."""
    if not value:
        return table.limit(0)
    return table.filter(F.col(key) == value).limit(1)


def first_per_key(table: DataFrame, key: str, *order: str) -> DataFrame:
    """One whole row per key, the one with the smallest `order` columns.

    min_by combines on the map side, so a key holding many rows sends one
    row per map task.
    """
    rest = [c for c in table.columns if c != key]
    best = table.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*table.columns)


def find_all(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows of `table` for the requested keys, one per distinct request.

    The requests are reduced to distinct keys first, so a key asked for very
    often costs no more than any other.
    """
    return table.join(requests.select(key).distinct(), key, "left_semi")


def not_found(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Distinct requested keys that the table lacks, with the error text."""
    wanted = requests.select(key).filter(F.col(key).isNotNull()).distinct()
    return wanted.join(table.select(key).distinct(), key, "left_anti").select(
        key, F.concat(F.lit("'"), F.col(key), F.lit("' not found.")).alias("detail"))


def clean_records(table: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column."""
    floating = (T.DoubleType, T.FloatType)
    return table.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, floating) else F.col(f.name)
        for f in table.schema.fields])


def with_defaults(table: DataFrame, defaults: dict) -> DataFrame:
    """Add the columns that are absent, filled with their default."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in table.columns}
    return table.withColumns(absent) if absent else table


def update_http_status(logs: DataFrame, updates: DataFrame) -> DataFrame:
    """Logs with the status of `updates(log_id, new_http_status)` applied.

    Other rows stay as they are. Several updates of one log: the largest
    status wins, so the result does not depend on row order.
    """
    new = updates.groupBy("log_id").agg(F.max("new_http_status").alias("_new"))
    return (logs.join(new, "log_id", "left")
            .withColumn("http_status", F.coalesce("_new", "http_status"))
            .select(*logs.columns))


def unmatched_updates(logs: DataFrame, updates: DataFrame) -> DataFrame:
    return updates.join(logs.select("log_id").distinct(), "log_id", "left_anti")


def _retried(log_id: Column) -> Column:
    # The outcome texts.
    return F.concat(F.lit("Webhook log '"), log_id, F.lit("' has been marked as successfully retried (http_status → 200)."))


def retry_successes(known: DataFrame) -> DataFrame:
    """The outcome of retried logs that are known to be there."""
    return known.select("log_id").distinct().select(
        F.lit(True).alias("success"), "log_id", F.lit(200).alias("new_http_status"), _retried(F.col("log_id")).alias("message"))


def retry_outcomes(requests: DataFrame, logs: DataFrame) -> DataFrame:
    """One outcome per requested log: retried with status 200, or not found."""
    known = logs.select("log_id", F.lit(True).alias("_known")).distinct()
    quoted = F.concat(F.lit("Webhook log '"), F.col("log_id"))
    return (requests.select("log_id").distinct().join(known, "log_id", "left")
            .select(
                F.coalesce("_known", F.lit(False)).alias("success"),
                "log_id",
                F.when(F.col("_known"), F.lit(200)).alias("new_http_status"),
                F.when(F.col("_known"), _retried(F.col("log_id"))).otherwise(F.concat(quoted, F.lit("' not found."))).alias("message")))
