"""Support knowledge as tables: decline codes and webhook delivery statuses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Code, title, meaning, when to expect it, merchant action of the support documents.
DECLINE_CODES = (
    ("05", "Do Not Honor",
     "The issuing bank has blocked this transaction without providing a specific reason. "
     "Often a catch-all for suspected fraud or account restrictions.", None,
     "Ask the cardholder to contact their bank or try an alternate payment method."),
    ("14", "Invalid Card Number",
     "The card number provided does not pass the Luhn check or is unknown to the issuing network.", None,
     "Verify the card number with the cardholder and re-enter."),
    ("51", "Insufficient Funds",
     "The cardholder's account does not have enough balance to cover the transaction amount.", None,
     "Request a different card or a reduced amount."),
    ("54", "Expired Card", "The card's expiry date has passed.", None,
     "Request the cardholder's updated card details."),
    ("57", "Transaction Not Permitted",
     "The card is not allowed for this merchant category (MCC). "
     "For example, a corporate card restricted to business travel used at a grocery store.", None,
     "No action possible; the cardholder must use a different card."),
    ("91", "Issuer Switch Inoperative", "The issuing bank's network is temporarily unavailable.", None,
     "Retry the transaction after a short delay (usually resolves within 15–60 minutes)."),
    ("93", "Risk Block",
     "The transaction has been flagged and blocked by internal fraud velocity rules. This occurs when a card or merchant "
     "has exceeded a threshold of suspicious activity (e.g., too many declined attempts in a short window).",
     "A sudden spike of code 93 declines usually indicates that the card network's fraud engine has temporarily blocked "
     "a specific card BIN or risk category associated with the merchant.",
     "Contact the payment gateway's risk team immediately. The block is usually temporary but may require manual review. "
     "Provide the affected transaction IDs and the time window for faster resolution."),
)

# HTTP status, meaning and what the gateway does about it.
WEBHOOK_STATUSES = (
    (200, "Delivery successful", "No retry"),
    (201, "Delivery successful", "No retry"),
    (400, "Payload rejected by your server", "No retry (client error)"),
    (401, "Authentication failure – webhook secret is wrong or expired", "No retry; alert raised"),
    (404, "Endpoint URL is incorrect", "No retry; alert raised"),
    (500, "Your server crashed", "Retried up to 3 times"),
    (502, "Upstream proxy failure", "Retried up to 3 times"),
    (503, "Server overloaded", "Retried up to 3 times"),
    (504, "Server took too long", "Retried up to 3 times"),
)


def decline_knowledge(spark: SparkSession) -> DataFrame:
    """The documented codes, seven rows."""
    return spark.createDataFrame(list(DECLINE_CODES), "code string, title string, meaning string, expect string, action string")


def webhook_knowledge(spark: SparkSession) -> DataFrame:
    """The documented delivery statuses, nine rows."""
    return spark.createDataFrame(list(WEBHOOK_STATUSES), "http_status int, status_meaning string, gateway_action string")
