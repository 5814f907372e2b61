"""Alerts from flagged windows, and reading them back per merchant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import alert_description, alert_type, iso_timestamp, round_exact
from ledgerpulse.schemas import ALERTS


def window_alerts(flagged: DataFrame) -> DataFrame:
    """One alert per row with prediction 1, in the alert table's schema."""
    hits = flagged.filter(F.col("prediction") == 1)
    score = F.col("decision") if "decision" in flagged.columns else F.lit(None)
    return hits.select(
        F.lit("batch").alias("source"),
        "merchant_id",
        F.current_timestamp().alias("detected_at"),
        F.col("timestamp").cast("timestamp").alias("window_start"),
        alert_type().alias("alert_type"),
        alert_description().alias("description"),
        score.cast("double").alias("anomaly_score"),
        F.struct(round_exact("decline_ratio", 4).alias("decline_ratio"),
                 F.col("total_transactions").cast("long").alias("total_transactions")).alias("metrics"),
        F.lit(None).cast("string").alias("payload_json"))


def alert_documents(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON text with an ISO timestamp."""
    return alerts.select("merchant_id", F.to_json(F.struct(
        "merchant_id", iso_timestamp("window_start").alias("timestamp"), "alert_type", "metrics")).alias("alert_json"))


def alert_messages(merchants: DataFrame, alerts: DataFrame) -> DataFrame:
    """One line per alert of every merchant, or the no-alert line.

    Lines stay separate rows, and the alerts meet the merchants in a semi join
    from their own side, so a merchant with very many alerts is neither
    gathered into one string nor into one task.
    """
    known = merchants.select("merchant_id").distinct()
    stamp = iso_timestamp(F.coalesce("window_start", "detected_at"), zulu=True)
    found = alerts.join(known, "merchant_id", "left_semi").select("merchant_id", F.concat(
        F.lit("ALERT FOUND: ["), F.coalesce(stamp, F.lit("unknown time")), F.lit("] - "),
        F.coalesce("description", F.lit("Anomaly detected"))).alias("message"))
    quiet = known.join(alerts.select("merchant_id").distinct(), "merchant_id", "left_anti").select(
        "merchant_id", F.concat(F.lit("No active ML alerts for "), F.col("merchant_id"), F.lit(".")).alias("message"))
    return found.unionAll(quiet)


def alerts_since(alerts: DataFrame, last_seen) -> DataFrame:
    """Alerts that arrived after `last_seen`; all of them if it is None."""
    return alerts if last_seen is None else alerts.filter(F.col("detected_at") > F.lit(last_seen))


def empty_alerts(spark) -> DataFrame:
    return spark.createDataFrame([], ALERTS)
