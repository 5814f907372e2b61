import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerpulse.functions import expressions as ex
from ledgerpulse.functions import transcripts as tx


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize("n, d, expected", [(3, 4, 75.0), (5, 0, 0.0), (0, 10, 0.0), (100, 100, 100.0), (1, 16, 6.2)])
def test_safe_pct(spark, n, d, expected):
    assert one(spark, ex.safe_pct(F.lit(n), F.lit(d))) == expected


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=50))
def test_rounding_is_exact(spark, values):
    values += [2.675, 0.125, 12.345, 0.5, 1.5, 2.5, 1e5 + 0.005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", ex.round_exact("v", 2).alias("r"), ex.fixed("v", 4).alias("t")).collect()
    assert all(r.r == round(r.v, 2) for r in rows)
    assert all(float(r.t) == float(f"{r.v:.4f}") for r in rows)


def test_number_coercion(spark):
    rows = spark.createDataFrame([("100.0",), (None,), ("bad",)], "x string").select(ex.to_number("x").alias("v")).collect()
    assert [r.v for r in rows] == [100.0, 0.0, 0.0]


def test_alert_types_are_strict(spark):
    def kind(blocks, ratio):
        return one(spark, ex.alert_type(F.lit(blocks), F.lit(ratio)))
    assert kind(15, 0.1) == "High Risk Block Spike" and kind(10, 0.1) == "General Transaction Anomaly"
    assert kind(0, 0.85) == "Elevated Decline Ratio" and kind(0, 0.6) == "General Transaction Anomaly"


@pytest.mark.parametrize("ratio, declined, total, avg, text", [
    (148 / 150, 148, 150, 2.5,
     "High volume of failed transactions detected: 148/150 declined (ratio: 98.67%, avg amount: $2.50)"),
    (0.8, 8, 10, 1.0, "Elevated decline rate: 8/10 declined (ratio: 80.00%)"),
    (0.5, 5, 10, 99.999, "Anomalous transaction pattern detected: 10 transactions, 5 declined, avg amount $100.00")])
def test_descriptions(spark, ratio, declined, total, avg, text):
    assert one(spark, ex.alert_description(F.lit(ratio), F.lit(declined), F.lit(total), F.lit(avg))) == text


def test_hour_of_day(spark):
    df = spark.createDataFrame([("2026-03-07T23:10:00Z",), ("2026-03-07T10:10:00+00:00",), ("2026-03-07T01:30:00+05:30",),
                                ("2026-03-07T04:00:00",), ("nonsense",), (None,)], "t string")
    rows = df.select(ex.hour_of_day("t").alias("h"), F.hour(F.current_timestamp()).alias("now")).collect()
    assert [r.h for r in rows[:4]] == [23, 10, 20, 4] and all(r.h == r.now for r in rows[4:])


def test_ids_queries_and_steps(spark):
    assert one(spark, ex.padded_id("TXN-", F.lit(42))) == "TXN-00000042"
    assert one(spark, ex.padded_id("TXN-", F.lit(1234567890))) == "TXN-1234567890"
    assert one(spark, ex.transaction_id_in(F.lit("why did txn-00194400 fail"))) == "txn-00194400"
    assert one(spark, ex.transaction_id_in(F.lit("none"))) == ""
    null = F.lit(None).cast("string")
    assert one(spark, ex.field_query({"decline_code": null})) == "general FinTech query"
    assert one(spark, ex.field_query({"decline_code": F.lit("93"), "x": null, "y": F.lit(5)})) == "decline_code 93 y 5"
    assert one(spark, ex.next_steps(F.lit("93_Risk_Block"), F.lit(503))) == ["LOOK_UP_CODE", "RETRY_WEBHOOK", "REPORT"]
    assert one(spark, ex.next_steps(null, F.lit(200))) == ["REPORT"]


@pytest.mark.parametrize("status, http, expected", [
    ("SUCCESS", 500, "RETRY"), ("SUCCESS", 504, "RETRY"), ("SUCCESS", 401, "ROTATE_SECRET"), ("SUCCESS", 400, "CLIENT_ERROR"),
    ("SUCCESS", 404, "FIX_URL"), ("SUCCESS", 201, "OK"), ("DECLINED", 500, "NOTHING_TO_DELIVER")])
def test_remediation(spark, status, http, expected):
    assert one(spark, ex.remediation(F.lit(http), F.lit(status))) == expected


def test_event_type_and_outcomes(spark):
    assert [one(spark, ex.event_type_of(F.lit(s))) for s in ("SUCCESS", "DECLINED", "PENDING")] == [
        "payment.success", "payment.failed", "payment.pending"]
    assert one(spark, ex.outcome_label(F.lit(1), F.lit(0))) == "FN (False Negative)"
    assert one(spark, ex.clip_lower(F.lit(3.0))) == 50.0


def test_live_features_with_missing_fields(spark):
    df = spark.createDataFrame([(None, None, None, None, "2026-03-07T05:00:00Z"), ("declined", "93_Risk_Block", 401, 9.5, "2026-03-07T05:00:00Z")],
                               "status string, decline_code string, webhook_http_status int, amount double, timestamp string")
    vector = ex.feature_vector(ex.live_feature_map(), ["amount", "is_declined", "is_risk_block", "is_webhook_401",
                                                       "is_webhook_error", "hour_of_day", "unknown"])
    assert [r.v for r in df.select(vector.alias("v")).collect()] == [[0, 0, 0, 0, 0, 5, 0], [9.5, 1, 1, 1, 1, 5, 0]]


INCOMPLETE = [
    ("The decline code of '93_Risk_Block'. To understand this, I'll check our knowledge base.", True),
    ("I need to look up the definition in our knowledge base", True), ("Let me consult the KB", True),
    ("LET ME SEARCH THE DOCUMENTATION", True), ("I checked the knowledge base and found it.", False),
    ("I'll check. The knowledge base says so", False), ("", False), (None, False)]


def test_incomplete_replies(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(INCOMPLETE)], "i int, text string")
    rows = df.select("i", tx.is_incomplete("text").alias("v")).orderBy("i").collect()
    assert [r.v for r in rows] == [e for _, e in INCOMPLETE]


@pytest.mark.parametrize("text, code", [
    ("decline code of '93_Risk_Block'", "93_Risk_Block"), ('code "51_Insufficient_Funds"', "51_Insufficient_Funds"),
    ("decline_code: 05_Do_Not_Honor", "05_Do_Not_Honor"), ("error code is '14_X'", "14_X"), ("code 93 only", None), ("none", None)])
def test_decline_code_in_text(spark, text, code):
    assert one(spark, tx.decline_code_in(F.lit(text))) == code


STRIP = [
    ('Hi {"name": "search_knowledge_base", "parameters": {"query": "a } b"}} there', "Hi  there"),
    ('{"name": "some_other_thing", "value": 42}', '{"name": "some_other_thing", "value": 42}'),
    ('x\n\n\n\ny', "x\n\ny"), ('{"name": "retry_failed_webhook"} {open', "{open"), ("", ""), (None, None),
    ('a {"k": "un { closed', 'a {"k": "un { closed'), ('{"a": {"b": {"name": "retry_failed_webhook"}}}', '{"a": {"b": {"name": "retry_failed_webhook"}}}'),
    ('{"name": "check_ml_system_alerts", "p": {"a": {"b": {"c": "\\"}"}}}}', "")]


def test_tool_calls_are_cut(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(STRIP)], "i int, text string")
    rows = df.select("i", tx.strip_tool_calls("text").alias("v"), tx.has_tool_call("text").alias("leak")).orderBy("i").collect()
    assert [r.v for r in rows] == [e for _, e in STRIP]
    assert [r.leak for r in rows] == [True, False, False, True, False, False, False, True, True]


def test_raw_json(spark):
    assert one(spark, tx.has_raw_json(F.lit("a\n{b"))) and one(spark, tx.has_raw_json(F.lit("{b")))
    assert not one(spark, tx.has_raw_json(F.lit("a {b")))
