"""Scalar expressions on telemetry columns. All stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds that results must carry unchanged.
RISK_BLOCK_CODE = "93_Risk_Block"
ISSUER_DOWN_CODE = "91_Issuer_Switch_Inoperative"
CARD_TEST_CODES = ("14_Invalid_Card_Number", "54_Expired_Card")
RISK_BLOCK_SPIKE = 10
ELEVATED_RATIO = 0.6
OUTCOME_LABELS = {
    "TP": "TP (True Positive)",
    "FP": "FP (False Positive)",
    "FN": "FN (False Negative)",
    "TN": "TN (True Negative)",
}
DEFAULT_QUERY = "general FinTech query"


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- numbers ---------------------------------------------------------------

def safe_divide(numerator, denominator) -> Column:
    n, d = _c(numerator), _c(denominator)
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def fixed(value, digits: int) -> Column:
    """Text with that many decimals, ties decided on the exact binary value."""
    return F.call_function("format_number", _c(value), F.lit("0." + "0" * digits))


def round_exact(value, digits: int) -> Column:
    """Rounding on the exact binary value, half to even (`round(2.675, 2)` is 2.67)."""
    return fixed(value, digits).cast("double")


def safe_pct(numerator, denominator) -> Column:
    """Percentage with one decimal; 0.0 for an empty base."""
    n, d = _c(numerator), _c(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(round_exact(n / d * F.lit(100.0), 1))


def to_number(value, default: float = 0.0) -> Column:
    """Parse to double; null and unparsable give the default."""
    return F.coalesce(_c(value).try_cast("double"), F.lit(float(default)))


def nan_to_null(value) -> Column:
    c = _c(value)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def clip_lower(value, bound: float = 50.0) -> Column:
    return F.greatest(_c(value), F.lit(float(bound)))


# ---- strings ---------------------------------------------------------------

def padded_id(prefix: str, number, width: int = 8) -> Column:
    """`TXN-00000042`; longer numbers keep all their digits."""
    digits = _c(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def event_type_of(status) -> Column:
    s = _c(status)
    return (F.when(s == "SUCCESS", F.lit("payment.success"))
            .when(s == "DECLINED", F.lit("payment.failed"))
            .otherwise(F.lit("payment.pending")))


def transaction_id_in(text) -> Column:
    """First `TXN-<digits>` in free text, case-insensitive; empty if none."""
    return F.coalesce(F.regexp_extract(_c(text), r"(?i)(TXN-\d+)", 1), F.lit(""))


def decline_code_number(decline_code) -> Column:
    return F.regexp_extract(_c(decline_code), r"^(\d+)", 1)


def field_query(fields: dict[str, Column]) -> Column:
    """`name value name value` over the non-null fields, or the default query."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(k + " "), v.cast("string"))) for k, v in fields.items()]
    joined = F.concat_ws(" ", *parts)
    return F.when(joined == "", F.lit(DEFAULT_QUERY)).otherwise(joined)


# ---- time ------------------------------------------------------------------

def iso_timestamp(value, zulu: bool = False) -> Column:
    """`2026-03-07T10:10:00+00:00`, or the `...Z` form."""
    tail = "'Z'" if zulu else "'+00:00'"
    return F.date_format(_c(value), f"yyyy-MM-dd'T'HH:mm:ss{tail}")


def plus_seconds(ts, seconds) -> Column:
    s = _c(seconds)
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))


def parsed_event_time(iso) -> Column:
    return F.try_to_timestamp(_c(iso))


def hour_of_day(iso) -> Column:
    """UTC hour; the current hour if the text is missing or no timestamp."""
    return F.hour(F.coalesce(parsed_event_time(iso), F.current_timestamp()))


# ---- classification --------------------------------------------------------

def alert_type(risk_block_count="risk_block_count", decline_ratio="decline_ratio",
               risk_threshold: float = RISK_BLOCK_SPIKE, ratio_threshold: float = ELEVATED_RATIO) -> Column:
    return (F.when(_c(risk_block_count) > risk_threshold, F.lit("High Risk Block Spike"))
            .when(_c(decline_ratio) > ratio_threshold, F.lit("Elevated Decline Ratio"))
            .otherwise(F.lit("General Transaction Anomaly")))


def alert_description(ratio="decline_ratio", declined="decline_count",
                      total="total_transactions", average="avg_amount") -> Column:
    r, d, t = _c(ratio), _c(declined), _c(total)
    a = F.round(_c(average), 9)  # takes out the noise of the summation order
    counts = F.concat(d.cast("string"), F.lit("/"), t.cast("string"), F.lit(" declined (ratio: "),
                      fixed(r * F.lit(100.0), 2), F.lit("%"))
    money = F.concat(F.lit("avg amount $"), fixed(a, 2))
    return (F.when(r > 0.8, F.concat(
                F.lit("High volume of failed transactions detected: "), counts,
                F.lit(", avg amount: $"), fixed(a, 2), F.lit(")")))
            .when(r > 0.5, F.concat(F.lit("Elevated decline rate: "), counts, F.lit(")")))
            .otherwise(F.concat(
                F.lit("Anomalous transaction pattern detected: "), t.cast("string"), F.lit(" transactions, "),
                d.cast("string"), F.lit(" declined, "), money)))


def is_delivered(http_status) -> Column:
    return _c(http_status).between(200, 299)


def is_failed(status="status", http_status="http_status") -> Column:
    """Not SUCCESS, or delivered with a non-2xx status. No log is no failure."""
    return F.coalesce(_c(status) != "SUCCESS", F.lit(True)) | F.coalesce(~is_delivered(http_status), F.lit(False))


def ground_truth(decline_code="decline_code", http_status="http_status") -> Column:
    """1 for a risk block or a 401 delivery, else 0 (nulls count as 0)."""
    hit = (F.coalesce(_c(decline_code) == RISK_BLOCK_CODE, F.lit(False))
           | F.coalesce(_c(http_status) == 401, F.lit(False)))
    return hit.cast("int")


def anomaly_flag(label) -> Column:
    """-1/1 labels to 1/0."""
    return F.when(_c(label) == -1, F.lit(1)).otherwise(F.lit(0))


def outcome_label(actual, predicted) -> Column:
    y, p = _c(actual), _c(predicted)
    return (F.when((p == 1) & (y == 1), F.lit(OUTCOME_LABELS["TP"]))
            .when((p == 1) & (y == 0), F.lit(OUTCOME_LABELS["FP"]))
            .when((p == 0) & (y == 1), F.lit(OUTCOME_LABELS["FN"]))
            .otherwise(F.lit(OUTCOME_LABELS["TN"])))


def remediation(http_status="http_status", status="status") -> Column:
    h, s = _c(http_status), _c(status)
    return (F.when(s == "DECLINED", F.lit("NOTHING_TO_DELIVER"))
            .when(h.between(500, 599), F.lit("RETRY"))
            .when(h == 401, F.lit("ROTATE_SECRET"))
            .when(h == 400, F.lit("CLIENT_ERROR"))
            .when(h == 404, F.lit("FIX_URL"))
            .when(is_delivered(h), F.lit("OK"))
            .otherwise(F.lit("REVIEW")))


def next_steps(decline_code="decline_code", http_status="http_status") -> Column:
    """Ordered follow-up steps of one transaction; REPORT always comes last."""
    steps = F.array(
        F.when(_c(decline_code).isNotNull(), F.lit("LOOK_UP_CODE")),
        F.when(_c(http_status).between(500, 599), F.lit("RETRY_WEBHOOK")),
        F.lit("REPORT"),
    )
    return F.array_compact(steps)


# ---- live-event features ---------------------------------------------------

def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def live_feature_map(prefix: str = "") -> dict[str, Column]:
    """All features of one live event, with defaults for absent fields."""
    f = lambda name: F.col(prefix + name)
    status = F.upper(F.coalesce(f("status"), F.lit("")))
    code = F.coalesce(f("decline_code"), F.lit(""))
    http = F.coalesce(f("webhook_http_status"), F.lit(200))
    return {
        "amount": F.coalesce(f("amount"), F.lit(0.0)).cast("double"),
        "is_declined": _flag(status == "DECLINED"),
        "is_success": _flag(status == "SUCCESS"),
        "is_risk_block": _flag(code == RISK_BLOCK_CODE),
        "is_webhook_401": _flag(http == 401),
        "is_webhook_error": _flag(http >= 400),
        "webhook_http_status": http.cast("double"),
        "hour_of_day": hour_of_day(f("timestamp")).cast("double"),
    }


def feature_vector(features: dict[str, Column], order) -> Column:
    """Array of doubles in model order; an unknown feature gives 0.0."""
    return F.array(*[F.coalesce(features[n], F.lit(0.0)) if n in features else F.lit(0.0) for n in order])


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
