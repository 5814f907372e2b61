"""Every operator as a named query over the supplied tables.

Each query takes the session and the folder of the parquet tables, reads the
whole tables it needs and returns a DataFrame.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions import expressions as ex
from ledgerpulse.functions import transcripts as tx
from ledgerpulse.operators import (
    alerts, detectors, evaluation, features, guardrails, joins, kpi, lookups, quality, ranking, retrieval, sets, sliding,
)
from ledgerpulse.operators.iforest import IsolationForest, IsolationForestModel, fixed_forest
from ledgerpulse.operators.models import FraudDetector, MerchantHealthMonitor, detect_anomalies, label_live_events
from ledgerpulse.operators.outliers import (
    Gaussian, Scaler, fit_elliptic_envelope, fit_linear_autoencoder, fit_local_outlier_factor, fit_one_class_svm,
)
from ledgerpulse.plans import comparison, views
from ledgerpulse.schemas import COMPARISON_FEATURES, LIVE_FEATURES, MERCHANTS, WINDOW_FEATURES, numeric_columns
from ledgerpulse.session import cut_lineage, dealt, fresh_folder
from ledgerpulse.sources import files, messages
from ledgerpulse.sources.alert_table import append_alerts, read_alerts
from ledgerpulse.sources.files import is_folder
from ledgerpulse.sources.keyed_table import KeyedTable
from ledgerpulse.streaming import ledger, scoring, windows

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _txns(spark, d) -> DataFrame:
    return views.transactions(spark, d)


def _logs(spark, d) -> DataFrame:
    return views.webhook_logs(spark, d)


def _merchants(spark, d) -> DataFrame:
    return views.merchants(spark, d)


def _joined(spark, d) -> DataFrame:
    return joins.transactions_with_logs(_txns(spark, d), _logs(spark, d))


def _day_features(spark, d) -> DataFrame:
    return features.window_features(_txns(spark, d), "1 day")


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- windowed features and alerts ------------------------------------------

@query
def features_1day(spark, d):
    return _rounded(_day_features(spark, d), "decline_ratio", "avg_amount")


@query
def features_10min(spark, d):
    return _rounded(features.window_features(_txns(spark, d)), "decline_ratio", "avg_amount")


@query
def features_reduced(spark, d):
    return _rounded(features.reduced_features(_txns(spark, d), "1 day"), "decline_ratio", "avg_amount")


@query
def features_order_days(spark, d):
    """Daily features on the larger order table."""
    return _rounded(features.window_features(views.order_transactions(spark, d), "1 day"), "decline_ratio", "avg_amount", digits=4)


@query
def alerts_classified(spark, d):
    return _day_features(spark, d).select(
        "merchant_id", "timestamp", "risk_block_count", ex.alert_type(risk_threshold=1).alias("alert_type"),
        ex.round_exact("decline_ratio", 4).alias("decline_ratio"), "total_transactions")


@query
def alert_descriptions(spark, d):
    return _day_features(spark, d).select("merchant_id", "timestamp", ex.alert_description().alias("description"))


def _rule_alerts(spark, d):
    flagged = _day_features(spark, d).withColumn("prediction", (F.col("decline_ratio") > 0.6).cast("int"))
    return alerts.window_alerts(flagged)


@query
def alert_records(spark, d):
    """Alerts of the windows a rule flags, metrics flattened."""
    return _rule_alerts(spark, d).select(
        "merchant_id", ex.iso_timestamp("window_start").alias("window_start"), "alert_type", "description",
        F.col("metrics.decline_ratio").alias("decline_ratio"),
        F.col("metrics.total_transactions").alias("total_transactions"))


@query
def alert_json(spark, d):
    return alerts.alert_documents(_rule_alerts(spark, d))


@query
def alerts_by_merchant(spark, d):
    return alerts.alert_messages(_merchants(spark, d), _rule_alerts(spark, d))


@query
def new_alerts(spark, d):
    """Alerts that came in after the last look; the window start stands for the arrival."""
    arrived = _rule_alerts(spark, d).withColumn("detected_at", F.col("window_start"))
    last_look = datetime(2024, 1, 15, tzinfo=timezone.utc)
    return alerts.alerts_since(arrived, last_look).select(
        "merchant_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "description")


# ---- lookups and update ----------------------------------------------------

def _requests(spark, d):
    """Merchant ids asked for, one request per event; some are unknown."""
    return views.table(spark, d, "events").selectExpr(
        "concat('merchant_id_', cast(user_id + (event_id % 3) * 150000 as string)) as merchant_id")


@query
def merchant_lookup(spark, d):
    return lookups.find_all(_requests(spark, d), _merchants(spark, d), "merchant_id")


@query
def merchant_not_found(spark, d):
    return lookups.not_found(_requests(spark, d), _merchants(spark, d), "merchant_id")


@query
def txn_lookup(spark, d):
    """Transactions whose delivery crashed."""
    asked = _logs(spark, d).filter(F.col("http_status") >= 500).select("transaction_id")
    return lookups.find_all(asked, _txns(spark, d), "transaction_id")


@query
def first_log_per_txn(spark, d):
    logs = views.line_logs(spark, d)
    return lookups.first_per_key(logs, "transaction_id", "log_id", "timestamp", "http_status", "delivery_attempts")


@query
def txn_details_with_log(spark, d):
    details = joins.transaction_details(_txns(spark, d), _logs(spark, d))
    return details.select(
        "transaction_id", "merchant_id", "status", "decline_code", F.col("webhook_log").isNotNull().alias("has_log"),
        F.col("webhook_log.log_id").alias("log_id"), F.col("webhook_log.http_status").alias("http_status"),
        F.col("webhook_log.delivery_attempts").alias("delivery_attempts"))


def _updates(spark, d):
    """Retried logs set to 200, for every failed transaction; some have no log."""
    return (_txns(spark, d).filter(F.col("status") == "DECLINED")
            .select(F.regexp_replace("transaction_id", "^TXN", "WH").alias("log_id"), F.lit(200).alias("new_http_status")))


@query
def webhook_update(spark, d):
    return lookups.update_http_status(_logs(spark, d), _updates(spark, d))


@query
def webhook_update_stored(spark, d):
    """The same update of a stored table, run twice, and read back."""
    logs = _logs(spark, d)
    held = KeyedTable(spark, fresh_folder(spark, "logs"), logs.schema, "log_id", 16)
    held.upsert(logs)
    for _ in range(2):
        held.update(_updates(spark, d).select("log_id", F.col("new_http_status").alias("http_status")))
    return held.read()


@query
def bulk_retry_stored(spark, d):
    """Every retryable delivery of a stored table sent again, run twice, and read back."""
    logs = _logs(spark, d)
    held = KeyedTable(spark, fresh_folder(spark, "retried"), logs.schema, "log_id", 16)
    held.upsert(logs)
    for _ in range(2):
        held.update(detectors.retryable_logs(_txns(spark, d), held.read()).withColumn("http_status", F.lit(200)))
    return held.read().select("log_id", "http_status", "delivery_attempts")


@query
def webhook_update_unmatched(spark, d):
    return lookups.unmatched_updates(_logs(spark, d), _updates(spark, d))


@query
def retry_outcomes(spark, d):
    return lookups.retry_outcomes(_updates(spark, d), _logs(spark, d))


@query
def records_nan_to_null(spark, d):
    dirty = _txns(spark, d).select(
        "transaction_id", F.expr("case when card_bin = '411111' then double('NaN') else amount end").alias("amount"))
    return lookups.clean_records(dirty)


@query
def numeric_columns_only(spark, d):
    orders = views.table(spark, d, "orders")
    return orders.select(*numeric_columns(orders))


@query
def column_defaults(spark, d):
    bare = _txns(spark, d).drop("decline_code")
    return lookups.with_defaults(bare, {"decline_code": ""}).select("transaction_id", "decline_code", "amount")


@query
def numeric_coercion(spark, d):
    """The number in the text after `k`, or 0; every fifth text holds no number."""
    raw = views.table(spark, d, "events").selectExpr(
        "event_id", "case when event_id % 5 = 0 then 'bad' when event_id % 7 = 0 then null "
        "else regexp_extract(props, '([0-9]+)', 1) end as raw")
    return raw.select("event_id", ex.to_number("raw").alias("number"))


@query
def boolean_filters(spark, d):
    return _joined(spark, d).filter(
        ((F.col("merchant_id") == "merchant_id_2") & (F.col("amount") >= 1) & (F.col("amount") <= 50)
         & F.col("decline_code").isNull()) | (F.col("http_status") == 401)
    ).select("transaction_id", "merchant_id", "amount", "http_status")


@query
def time_range_filters(spark, d):
    ts = F.col("timestamp")
    start, end = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")
    return _txns(spark, d).agg(
        F.count_if(ts.between(start, end)).alias("closed"),
        F.count_if((ts >= start) & (ts < end)).alias("half_open"))


@query
def membership_filter(spark, d):
    return _txns(spark, d).filter(F.col("decline_code").isin(*ex.CARD_TEST_CODES)).select("transaction_id", "decline_code")


@query
def prefix_filter(spark, d):
    return _logs(spark, d).filter(F.col("log_id").startswith("WH-0000")).select("log_id", "http_status")


# ---- joins -----------------------------------------------------------------

@query
def txn_log_left_join(spark, d):
    return _joined(spark, d)


@query
def order_line_left_join(spark, d):
    """The left join with many logs per transaction, summed per outcome."""
    joined = joins.transactions_with_logs(views.order_transactions(spark, d), views.line_logs(spark, d))
    return joined.groupBy("status", "http_status").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query
def merchant_logs_semi(spark, d):
    return joins.logs_of_merchant(_txns(spark, d), _logs(spark, d), "merchant_id_2")


@query
def planted_log_semi(spark, d):
    """Logs of card-testing transactions."""
    probed = _txns(spark, d).filter(F.col("decline_code").isin(*ex.CARD_TEST_CODES))
    return lookups.find_all(probed, _logs(spark, d), "transaction_id")


@query
def merchant_category_join(spark, d):
    """Transactions and amount per merchant category; merchants are summed before the lookup."""
    per_merchant = _txns(spark, d).groupBy("merchant_id").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return (joins.with_merchant_columns(per_merchant, _merchants(spark, d), "mcc_code")
            .groupBy("mcc_code").agg(F.sum("n").alias("n"), F.round(F.sum("amount"), 2).alias("amount")))


@query
def decline_kb_lookup(spark, d):
    return joins.decline_explanations(_txns(spark, d)).select(
        "transaction_id", "decline_code", "code", "title", "meaning", "expect", "action")


@query
def webhook_kb_lookup(spark, d):
    return joins.delivery_explanations(_logs(spark, d)).select("log_id", "http_status", "status_meaning", "gateway_action")


@query
def fk_orphans(spark, d):
    return joins.orphan_counts(_txns(spark, d), _logs(spark, d), _merchants(spark, d))


# ---- figures ---------------------------------------------------------------

@query
def success_counts(spark, d):
    return kpi.success_counts(_txns(spark, d))


@query
def success_rate(spark, d):
    return kpi.success_rate(_txns(spark, d))


@query
def success_rate_by_merchant(spark, d):
    return kpi.success_rate(_txns(spark, d), "merchant_id")


@query
def webhook_success_rate(spark, d):
    return kpi.webhook_success_rate(_logs(spark, d))


@query
def critical_failures(spark, d):
    return kpi.critical_failures(_txns(spark, d), _logs(spark, d))


@query
def failed_transactions(spark, d):
    return kpi.failed_transactions(_txns(spark, d), _logs(spark, d)).select(
        "transaction_id", "merchant_id", "status", "decline_code", "http_status")


@query
def decline_code_frequency(spark, d):
    return kpi.decline_code_frequency(_txns(spark, d))


@query
def decline_distribution(spark, d):
    return kpi.decline_distribution(views.order_transactions(spark, d))


@query
def http_status_frequency(spark, d):
    return kpi.http_status_frequency(_logs(spark, d))


@query
def merchant_diagnostics(spark, d):
    return kpi.merchant_diagnostics(_merchants(spark, d), _txns(spark, d), _logs(spark, d))


@query
def table_summary(spark, d):
    return _rounded(kpi.table_summary(_txns(spark, d)), "success_share", "declined_share", "median_amount")


@query
def order_summary(spark, d):
    return _rounded(kpi.table_summary(views.order_transactions(spark, d)), "success_share", "declined_share", "median_amount")


@query
def label_counts(spark, d):
    """Rows per incident tag after tagging, with the untagged ones."""
    txns = _txns(spark, d)
    tagged = detectors.tag_first(txns, F.col("decline_code") == ex.RISK_BLOCK_CODE, 50, "ANOM1_RISK_BLOCK")
    return kpi.value_counts(tagged, "_anomaly_tag").withColumnRenamed("_anomaly_tag", "tag")


@query
def distinct_values(spark, d):
    return kpi.distinct_values(_joined(spark, d), "merchant_id", "card_bin", "decline_code", "http_status")


@query
def volume_concentration(spark, d):
    return _rounded(kpi.volume_concentration(_txns(spark, d)), "top_bottom_ratio", "count_stddev")


@query
def hour_counts(spark, d):
    return kpi.hour_counts(_txns(spark, d))


@query
def hourly_profile(spark, d):
    return _rounded(kpi.hourly_profile(_txns(spark, d)), "hour_stddev")


@query
def burst_span(spark, d):
    coded = _txns(spark, d).filter(F.col("decline_code").isNotNull())
    return _rounded(kpi.burst_span(coded, "decline_code"), "span_seconds")


# ---- ranking ---------------------------------------------------------------

@query
def recent_txns_topn(spark, d):
    return ranking.recent_transactions_all(_txns(spark, d), 10).select("merchant_id", "rank", "transaction_id", "timestamp")


@query
def recent_txns_one_merchant(spark, d):
    return ranking.recent_transactions(_txns(spark, d), "merchant_id_3", 10)


@query
def recent_logs_topn(spark, d):
    return ranking.recent_logs_all(_txns(spark, d), _logs(spark, d), 10).select(
        "merchant_id", "rank", "log_id", "timestamp", "http_status")


@query
def recent_logs_one_merchant(spark, d):
    return ranking.recent_logs(_txns(spark, d), _logs(spark, d), "merchant_id_2", 10)


@query
def retry_preview(spark, d):
    return ranking.retry_candidates_preview(_txns(spark, d), _logs(spark, d))


@query
def first_success_per_merchant(spark, d):
    return ranking.first_matching(_txns(spark, d), F.col("status") == "SUCCESS", 5, "merchant_id").select(
        "merchant_id", "rank", "transaction_id")


@query
def first_declines(spark, d):
    return ranking.first_matching(_txns(spark, d), F.col("status") == "DECLINED", 50).select("transaction_id", "timestamp")


@query
def sequential_ids(spark, d):
    """Orders renumbered by date."""
    rows = views.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return ranking.sequential_ids(rows, ["o_orderdate", "o_orderkey"])


# ---- unions and key sets ---------------------------------------------------

@query
def union_feeds(spark, d):
    """Event and order transactions as one feed; orders have no BIN or currency."""
    orders = views.order_transactions(spark, d).withColumn("transaction_id", ex.padded_id("TXN-ORD-", "transaction_id"))
    return sets.union_feeds(_txns(spark, d), orders)


@query
def key_set_difference(spark, d):
    return sets.key_set_difference(_txns(spark, d), _logs(spark, d), "transaction_id")


# ---- scalar functions ------------------------------------------------------

@query
def timestamp_functions(spark, d):
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return _txns(spark, d).select(
        "transaction_id", F.to_timestamp(text).cast("timestamp_ntz").alias("parsed"),
        ex.iso_timestamp("timestamp").alias("iso_offset"), ex.iso_timestamp("timestamp", zulu=True).alias("iso_zulu"),
        ex.plus_seconds("timestamp", F.length("merchant_id")).alias("later"))


@query
def live_feature_vector(spark, d):
    """Model input of every live event, one column per place."""
    events = views.live_events(spark, d)
    order = [*LIVE_FEATURES, "no_such_feature"]
    vector = ex.feature_vector(ex.live_feature_map(), order)
    return events.select("transaction_id", vector.alias("v")).select(
        "transaction_id", *[F.col("v")[i].alias(n) for i, n in enumerate(order)])


@query
def recoded_events(spark, d):
    """Delivery event of each order status; unknown statuses are pending."""
    raw = views.table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "DECLINED").otherwise("OPEN")
    return raw.select("o_orderkey", ex.event_type_of(status).alias("event_type"), ex.clip_lower("o_totalprice", 50000.0).alias("clipped"))


@query
def rounded_amounts(spark, d):
    """Ties decided on the exact binary value."""
    price = views.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") * F.col("l_discount")).alias("x"))
    return price.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        ex.round_exact("x", 4).alias("d4"), ex.round_exact("x", 1).alias("d1"), ex.fixed("x", 2).alias("text"))


@query
def extracted_transaction_ids(spark, d):
    said = _txns(spark, d).select("transaction_id", F.expr(
        "case when card_bin = '411111' then 'status please' when card_bin = '400011' "
        "then concat('why did ', lower(transaction_id), ' fail?') else concat('see ', transaction_id, ' / TXN-1') end").alias("said"))
    return said.select("transaction_id", ex.transaction_id_in("said").alias("found"))


@query
def field_queries(spark, d):
    return _joined(spark, d).select("transaction_id", ex.field_query({
        "decline_code": F.col("decline_code"), "http_status": F.col("http_status")}).alias("query"))


@query
def json_round_trip(spark, d):
    """Rows to JSON text and back."""
    events = views.live_events(spark, d)
    parsed = messages.parse_live_events(messages.as_messages(events))
    return parsed.select("transaction_id", "merchant_id", "amount", "status", "decline_code", "webhook_http_status")


# ---- detectors -------------------------------------------------------------

@query
def detect_risk_block(spark, d):
    return detectors.risk_block_spikes(_txns(spark, d), "1 day", 2)


@query
def detect_auth_failure(spark, d):
    return _rounded(detectors.auth_failures(_txns(spark, d), _logs(spark, d), "1 day", 0.5, 2), "unauthorized_share")


@query
def detect_card_testing(spark, d):
    found = detectors.card_testing(_txns(spark, d), "1 day", at_least=2, min_declined=0.0, min_test_codes=0.0)
    return _rounded(found, "declined_share", "test_code_share")


@query
def detect_issuer_outage(spark, d):
    return _rounded(detectors.issuer_outages(_txns(spark, d), "1 day", 5, 0.1), "issuer_down_share")


@query
def detect_overload(spark, d):
    found = detectors.overloads(_txns(spark, d), _logs(spark, d), "1 day", 1.0, 0.25)
    return _rounded(found, "mean_txns", "overload_share")


def _plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("burst_start", "burst_end")})


@query
def detect_risk_block_sliding(spark, d):
    return _plain_times(sliding.risk_block_bursts(_txns(spark, d), "1 day", 2))


@query
def detect_auth_failure_sliding(spark, d):
    return _plain_times(sliding.auth_failure_bursts(_txns(spark, d), _logs(spark, d), "1 day", 0.5, 2))


@query
def detect_card_testing_sliding(spark, d):
    return _plain_times(sliding.card_testing_bursts(_txns(spark, d), "1 day", at_least=2, min_declined=0.0, min_test_codes=0.0))


@query
def detect_issuer_outage_sliding(spark, d):
    return _plain_times(sliding.issuer_outage_bursts(_txns(spark, d), "1 day", 5, 0.1))


@query
def detect_overload_sliding(spark, d):
    return _plain_times(sliding.overload_bursts(_txns(spark, d), _logs(spark, d), "1 day", 1.0, 0.25))


@query
def detect_reconciliation_gap(spark, d):
    return detectors.reconciliation_gaps(_txns(spark, d), _logs(spark, d)).select(
        "transaction_id", "merchant_id", "amount", "log_id", "http_status", "delivery_attempts")


@query
def remediation_class(spark, d):
    return detectors.remediation_classes(_txns(spark, d), _logs(spark, d))


@query
def bulk_retry(spark, d):
    return detectors.bulk_retry(_txns(spark, d), _logs(spark, d)).select("log_id", "http_status", "delivery_attempts")


@query
def bulk_retry_outcomes(spark, d):
    return detectors.bulk_retry_outcomes(_txns(spark, d), _logs(spark, d))


@query
def triage_steps(spark, d):
    return detectors.triage(_txns(spark, d), _logs(spark, d))


@query
def inject_labels(spark, d):
    """First 50 declines tagged as risk blocks, then 90 % of one BIN as issuer failures."""
    tagged = detectors.tag_first(_txns(spark, d), F.col("status") == "DECLINED", 50, "ANOM1_RISK_BLOCK",
                                 status="DECLINED", decline_code=ex.RISK_BLOCK_CODE)
    tagged = detectors.tag_share(tagged, F.col("card_bin") == "411111", 0.9, "ANOM4_ISSUER_DOWN",
                                 status="DECLINED", decline_code=ex.ISSUER_DOWN_CODE)
    return tagged.select("transaction_id", "status", "decline_code", F.col("_anomaly_tag").alias("tag"))


@query
def inject_dropped_webhooks(spark, d):
    """The first five successes of every merchant, tagged over earlier tags."""
    tagged = detectors.tag_first(_txns(spark, d), F.col("status") == "SUCCESS", 5, "ANOM6_DROPPED_WEBHOOK",
                                 per="merchant_id", overwrite=True)
    return tagged.select("transaction_id", F.col("_anomaly_tag").alias("tag"))


# ---- evaluation ------------------------------------------------------------

def _rule_predictions(spark, d):
    """Ground truth against a simple rule (declined, or an error status)."""
    return _joined(spark, d).select(
        "transaction_id", "status", ex.ground_truth().alias("y_true"),
        ex.anomaly_flag(F.when((F.col("status") == "DECLINED") | F.coalesce(F.col("http_status") >= 401, F.lit(False)), -1)
                        .otherwise(1)).alias("y_pred"))


@query
def ground_truth(spark, d):
    return _joined(spark, d).select("transaction_id", ex.ground_truth().alias("is_anomaly_actual"))


@query
def outcome_labels(spark, d):
    return _rule_predictions(spark, d).select("transaction_id", ex.outcome_label("y_true", "y_pred").alias("outcome"))


@query
def confusion_counts(spark, d):
    return evaluation.confusion_counts(_rule_predictions(spark, d), "status")


@query
def confusion_matrix(spark, d):
    matrix = evaluation.confusion_matrix(evaluation.confusion_counts(_rule_predictions(spark, d)))
    return matrix.select(*[F.col("matrix")[i][j].alias(n) for i, j, n in
                           ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])


def _label_scores(spark, d):
    """Precision and recall of quality 0 as a sign of toxic 1, per document language."""
    docs = views.table(spark, d, "documents").select("doc_id", "lang")
    judged = views.table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("lang").alias("model"), F.col("toxic").alias("y_true"), (1 - F.col("quality")).alias("y_pred"))
    return evaluation.precision_recall_f1(evaluation.confusion_counts(judged, "model"))


@query
def precision_recall_f1(spark, d):
    return _rounded(_label_scores(spark, d), "precision", "recall", "f1")


@query
def metrics_long(spark, d):
    return _rounded(evaluation.metrics_long(_label_scores(spark, d)), "score")


@query
def metrics_pivot(spark, d):
    pivot = evaluation.metrics_pivot(evaluation.metrics_long(_label_scores(spark, d)))
    return pivot.select("model", F.round("Precision", 6).alias("precision"), F.round("Recall", 6).alias("recall"),
                        F.round("F1-Score", 6).alias("f1"))


@query
def best_model(spark, d):
    return evaluation.best_model(_label_scores(spark, d)).select("model", F.round("f1", 6).alias("f1"))


# ---- quality ---------------------------------------------------------------

@query
def quality_report(spark, d):
    return quality.quality_report(_merchants(spark, d), _txns(spark, d), _logs(spark, d))


@query
def error_code_check(spark, d):
    parsed = messages.accepted(messages.parse_ingest(views.ingest_messages(spark, d)))
    return quality.error_code_only_when_failed(parsed)


# ---- ingest ----------------------------------------------------------------

@query
def ingest_validated(spark, d):
    return messages.accepted(messages.parse_ingest(views.ingest_messages(spark, d))).drop("metadata")


@query
def ingest_quarantine(spark, d):
    return messages.rejected(messages.parse_ingest(views.ingest_messages(spark, d))).select("event_id", "problem")


# ---- models ----------------------------------------------------------------

def _scores(df: DataFrame) -> DataFrame:
    return _rounded(df, "anomaly_score", "decision")


@query
def iforest_frozen_scores(spark, d):
    """Live events scored by the frozen forest."""
    scored = scoring.score_events(messages.as_messages(views.live_events(spark, d)), fixed_forest(), as_expression=True)
    return _scores(scored.select("transaction_id", "anomaly_score", "decision", "prediction"))


@query
def iforest_frozen_scores_udf(spark, d):
    """The same scores from Python workers, as for large forests."""
    scored = scoring.score_events(messages.as_messages(views.live_events(spark, d)), fixed_forest())
    return _scores(scored.select("transaction_id", "anomaly_score", "decision", "prediction"))


@query
def model_round_trip(spark, d):
    """The frozen forest saved, loaded and applied."""
    folder = fresh_folder(spark, "model")
    fixed_forest().save(spark, folder)
    scored = scoring.score_events(messages.as_messages(views.live_events(spark, d)), IsolationForestModel.load(spark, folder))
    return _scores(scored.select("transaction_id", "anomaly_score", "decision", "prediction"))


@query
def iforest_fit_predict(spark, d):
    return _scores(MerchantHealthMonitor().train_and_predict(_day_features(spark, d)))


@query
def iforest_alerts(spark, d):
    monitor = MerchantHealthMonitor()
    return monitor.generate_alerts(monitor.train_and_predict(_day_features(spark, d))).drop("detected_at")


@query
def iforest_reduced(spark, d):
    rows = _day_features(spark, d)
    return _scores(detect_anomalies(rows, key=("merchant_id", "timestamp")))


@query
def iforest_live_model(spark, d):
    """A 200-tree model fitted on all live events and applied to them."""
    events = scoring.with_live_features(messages.parse_live_events(messages.as_messages(views.live_events(spark, d))))
    events = cut_lineage(dealt(events.select("transaction_id", *LIVE_FEATURES)))
    _, labelled = label_live_events(events, key=("transaction_id",))
    return _scores(labelled).select("transaction_id", "anomaly_score", "decision", "prediction")


@query
def contamination_share(spark, d):
    """Share of training rows the fitted threshold flags."""
    forest = IsolationForest(("amount",), contamination=0.1, key=("transaction_id",))
    _, labelled = forest.fit_predict(_txns(spark, d).select("transaction_id", "amount"))
    return labelled.agg(F.round(F.avg("prediction"), 2).alias("flagged_share"))


@query
def fraud_anomaly(spark, d):
    rows = cut_lineage(_day_features(spark, d))
    detector = FraudDetector("anomaly").train(rows, key=("merchant_id", "timestamp"))
    return detector.predict(rows).select("merchant_id", "fraud_prediction")


@query
def gbt_fraud(spark, d):
    rows = comparison.labelled_features(_txns(spark, d), _logs(spark, d))
    return FraudDetector("supervised").train(rows, label="y_true").predict(rows).select(
        "transaction_id", "y_true", "fraud_prediction")


def _labelled(spark, d):
    return comparison.labelled_features(_txns(spark, d), _logs(spark, d))


@query
def scaled_features(spark, d):
    rows = cut_lineage(_labelled(spark, d))
    return _rounded(Scaler.fit(rows, COMPARISON_FEATURES).transform(rows), *COMPARISON_FEATURES)


@query
def mahalanobis(spark, d):
    """One plain (non-robust) pass over two features."""
    rows = _labelled(spark, d)
    distance = Gaussian.fit(rows, ["amount", "http_status"]).squared_distance()
    return rows.select("transaction_id", F.round(distance, 6).alias("d2"))


def _normal_and_all(spark, d):
    rows = cut_lineage(comparison.standardised(cut_lineage(_labelled(spark, d))))
    return rows.filter(F.col("y_true") == 0), rows


def _outliers(fit, spark, d):
    normal, rows = _normal_and_all(spark, d)
    found = fit(normal, list(COMPARISON_FEATURES)).transform(rows)
    return found.select("transaction_id", "y_true", F.round("outlier_score", 6).alias("outlier_score"), "prediction")


@query
def elliptic_envelope(spark, d):
    return _outliers(lambda n, f: fit_elliptic_envelope(n, f, 0.2), spark, d)


@query
def pca_reconstruction(spark, d):
    return _outliers(lambda n, f: fit_linear_autoencoder(n, f, 0.2), spark, d)


@query
def one_class_svm(spark, d):
    return _outliers(fit_one_class_svm, spark, d)


@query
def lof_scores(spark, d):
    """Local outlier factors as powers of ten: beside copies of a point they reach 10^10."""
    normal, rows = _normal_and_all(spark, d)
    model = fit_local_outlier_factor(normal, list(COMPARISON_FEATURES), 2, 0.2)
    above = F.col("outlier_score") > model.threshold * (1 + 1e-9)  # the score on the threshold is not above it, whatever its last digits
    return model.with_score(rows).select(
        "transaction_id", "y_true", F.round(F.log10("outlier_score"), 6).alias("log_score"), above.cast("int").alias("prediction"))


@query
def model_comparison(spark, d):
    scores = comparison.comparison(_txns(spark, d), _logs(spark, d))
    return _rounded(scores, "precision", "recall", "f1")


# ---- retrieval -------------------------------------------------------------

def _passages(spark, d):
    return views.table(spark, d, "embeddings").selectExpr(
        "vec_id", "embedding", "concat('group-', cast(label as string)) as source",
        "concat('passage ', cast(vec_id as string)) as text")


def _topics(spark, d):
    """One query vector per label: the mean of its vectors."""
    vectors = views.table(spark, d, "embeddings").select("label", array_to_vector("embedding").alias("v"))
    return vectors.groupBy(F.col("label").alias("query_id")).agg(
        vector_to_array(Summarizer.mean(F.col("v"))).alias("embedding"))


@query
def topk_vectors(spark, d):
    """The five vectors nearest to each label's mean."""
    return _rounded(retrieval.top_k(_topics(spark, d), _passages(spark, d), 5), "score")


@query
def kb_answer(spark, d):
    passages = _passages(spark, d)
    topics = _topics(spark, d)
    return retrieval.answers(topics, retrieval.top_k(topics, passages), passages)


@query
def chunk_documents(spark, d):
    docs = views.table(spark, d, "documents").select("doc_id", "source", "text")
    return retrieval.chunk_documents(docs)


@query
def chunk_pages(spark, d):
    return retrieval.chunk_documents(views.table(spark, d, "pages").select("page_id", F.col("html").alias("text")))


@query
def chunk_property_report(spark, d):
    docs = views.table(spark, d, "documents").select("doc_id", "source", "text")
    return retrieval.chunk_properties(retrieval.chunk_documents(docs), "source")


@query
def chunk_properties_by_document(spark, d):
    """Per document: whether it has chunks, all are parts of its text, and none is longer than the limit."""
    docs = views.table(spark, d, "documents").select("doc_id", "source", "text")
    chunks = retrieval.chunk_documents(docs.select("doc_id", "text")).select("doc_id", F.col("text").alias("chunk"))
    joined = docs.join(chunks, "doc_id", "left").groupBy("doc_id").agg(
        (F.count("chunk") > 0).alias("has_chunks"), F.coalesce(F.bool_and(F.contains("text", "chunk")), F.lit(True)).alias("parts_of_text"),
        (F.coalesce(F.max(F.length("chunk")), F.lit(0)) <= 500).alias("short_enough"))
    return joined


@query
def outlier_properties(spark, d):
    """Of each model: whether it flags its share of the training rows, and only rows that score above all others.

    The threshold is interpolated at the place (n - 1) * (1 - share) of the n ordered scores, so at most the
    n - 1 - floor of that place stand above it.
    """
    normal, rows = _normal_and_all(spark, d)
    names, share = list(COMPARISON_FEATURES), 0.2
    fitted = {"EllipticEnvelope": fit_elliptic_envelope(normal, names, share), "AutoEncoder": fit_linear_autoencoder(normal, names, share)}
    found = None
    for name, model in fitted.items():
        flagged = F.col("prediction") == 1
        part = model.transform(normal).agg(
            F.lit(name).alias("model"),
            (F.sum("prediction") <= F.count("*") - 1 - F.floor((F.count("*") - 1) * (1.0 - share))).alias("within_share"),
            (F.min(F.when(flagged, F.col("outlier_score"))) > F.max(F.when(~flagged, F.col("outlier_score")))).alias("in_order"))
        found = part if found is None else found.unionAll(part)
    return found


def _lines(spark, d) -> DataFrame:
    """Lines of the documents with a letter or digit as passages."""
    docs = views.table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return docs.filter(F.col("text").rlike(r"[\p{L}\p{N}]")).select(F.concat_ws("-", "doc_id", "line").alias("vec_id"), "text")


def _questions(spark, d) -> DataFrame:
    return views.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query
def kb_search_documents(spark, d):
    """Benchmark passages as questions to the lines of all documents."""
    return _rounded(retrieval.TermIndex(_lines(spark, d)).search(_questions(spark, d)).hits, "score")


@query
def kb_search_pairs(spark, d):
    """How much of the search is left out: questions, and whether fewer than a quarter of their pairs with different lines were scored."""
    questions = _questions(spark, d)
    found = retrieval.TermIndex(_lines(spark, d)).search(questions)
    whole = questions.agg(F.count("*").alias("questions")).withColumn("lines", F.lit(found.texts).cast("long"))
    return whole.crossJoin(found.scored.agg(F.count("*").alias("scored"))).select(
        "questions", "lines", (F.col("scored") * 4 < F.col("questions") * F.col("lines")).alias("below_a_quarter"))


@query
def kb_search_chunks(spark, d):
    """Benchmark passages as questions to the chunked documents."""
    docs = views.table(spark, d, "documents").select("doc_id", "text")
    chunks = retrieval.chunk_documents(docs).withColumn("vec_id", F.concat_ws("-", "doc_id", "chunk_no"))
    return _rounded(retrieval.TermIndex(chunks).search(_questions(spark, d)).hits, "score")


@query
def kb_answers_for_codes(spark, d):
    """One question per decline code and delivery status seen, answered from the chunked documents."""
    docs = views.table(spark, d, "documents").select("doc_id", "source", "text")
    chunks = cut_lineage(retrieval.chunk_documents(docs).withColumn("vec_id", F.concat_ws("-", "doc_id", "chunk_no")))
    asked = _joined(spark, d).select(ex.field_query({
        "decline_code": F.col("decline_code"), "http_status": F.col("http_status")}).alias("text")).distinct()
    asked = cut_lineage(asked.withColumn("query_id", F.col("text")))
    return retrieval.answers(asked, retrieval.TermIndex(chunks).search(asked).hits, chunks)


# ---- transcripts -----------------------------------------------------------

@query
def transcript_flags(spark, d):
    return guardrails.flag_replies(views.transcripts(spark, d)).drop("text")


@query
def transcript_clean(spark, d):
    return guardrails.clean_replies(views.transcripts(spark, d)).select("conv_id", "turn", "clean_text")


@query
def transcript_repair(spark, d):
    return guardrails.repair(views.transcripts(spark, d)).select("conv_id", "turn", "repair_status", "repaired_text")


@query
def transcript_audit(spark, d):
    return guardrails.audit(views.transcripts(spark, d), "role")


@query
def transcript_audit_by_conversation(spark, d):
    return guardrails.audit(views.transcripts(spark, d), "conv_id")


# ---- sources and sinks -------------------------------------------------------

@query
def csv_round_trip(spark, d):
    """Merchants written as CSV and read with their types."""
    folder = fresh_folder(spark, "csv")
    files.write_csv(_merchants(spark, d), folder)
    return files.read_csv(spark, folder, MERCHANTS)


@query
def csv_missing_file(spark, d):
    """A table whose file is missing is empty; the other one is whole."""
    folder = fresh_folder(spark, "csv-tables")
    files.write_csv(_merchants(spark, d), f"{folder}/merchants.csv")
    tables = files.TelemetryTables(spark, folder)
    return tables.merchants.agg(F.count("*").alias("merchants")).crossJoin(tables.webhook_logs.agg(F.count("*").alias("logs")))


@query
def validated_scan(spark, d):
    """Transactions written as CSV and loaded with their required columns checked."""
    folder = fresh_folder(spark, "csv-transactions")
    files.write_csv(_txns(spark, d).drop("card_bin"), folder)
    return files.load_transactions(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query
def published_messages(spark, d):
    """Live events published as JSON and parsed from what was published."""
    folder = fresh_folder(spark, "messages")
    messages.publish(views.live_events(spark, d), "files", folder)
    return messages.parse_live_events(spark.read.text(folder)).select("transaction_id", "merchant_id", "amount", "decline_code", "timestamp")


@query
def alert_table_round_trip(spark, d):
    """Rule alerts appended to the alert table in two parts and read back."""
    folder, found = fresh_folder(spark, "alerts"), cut_lineage(_rule_alerts(spark, d).withColumn("detected_at", F.lit(None).cast("timestamp")))
    for part in (F.col("merchant_id") < "merchant_id_5", F.col("merchant_id") >= "merchant_id_5"):
        append_alerts(found.filter(part), folder)
    return read_alerts(spark, folder).select("merchant_id", ex.iso_timestamp("window_start").alias("window_start"), "alert_type", "description")


@query
def passage_store_round_trip(spark, d):
    """Embeddings stored as a table, loaded and counted per label."""
    folder = fresh_folder(spark, "passages")
    rows = views.table(spark, d, "embeddings")
    files.save_table(rows, folder)
    return files.load_table(spark, folder, rows.schema).groupBy("label").agg(
        F.count("*").alias("n"), F.min(F.size("embedding")).alias("dims"), F.sum("vec_id").alias("ids"))


@query
def merged_view_empty_sides(spark, d):
    """An empty side gives the other one unchanged."""
    txns, logs = _txns(spark, d), _logs(spark, d)
    left = joins.merged_view(txns, logs.limit(0)).select(F.col("transaction_id").alias("id"), F.lit("transaction").alias("kind"))
    right = joins.merged_view(txns.limit(0), logs).select(F.col("log_id").alias("id"), F.lit("log").alias("kind"))
    return left.unionByName(right)


@query
def empty_features(spark, d):
    """Windows of no transactions at all, counted beside those of all."""
    txns = _txns(spark, d)
    none = features.window_features(txns.limit(0), "1 day").agg(F.count("*").alias("of_none"))
    return none.crossJoin(features.window_features(txns, "1 day").agg(F.count("*").alias("of_all")))


# ---- streams ---------------------------------------------------------------

@query
def live_alerts_batch(spark, d):
    """Batch twin of the event scorer: only anomalous events remain."""
    found = scoring.live_alerts(messages.as_messages(views.live_events(spark, d)), fixed_forest(), as_expression=True)
    return _rounded(found.select("merchant_id", "source", "anomaly_score", "payload_json"), "anomaly_score").select(
        F.get_json_object("payload_json", "$.transaction_id").alias("transaction_id"), "merchant_id", "source", "anomaly_score")


def _event_stream(spark, d):
    """The event table read as a stream of files: a folder of part files, or one file beside the other tables."""
    schema = views.table(spark, d, "events").schema
    reader = spark.readStream.schema(schema)
    if is_folder(spark, f"{d}/events.parquet"):
        return reader.parquet(f"{d}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(d)


def _drained(spark, d, start) -> None:
    """Runs a windowed query over the whole event stream and flushes its open windows."""
    source = _event_stream(spark, d).selectExpr(*views.transaction_columns())
    windows.BoundedInput(source, fresh_folder(spark, "end-of-input")).drain(
        lambda stream: start(windows.streaming_features(stream, "1 day", windows.WHOLE_INPUT)))


@query
def stream_features(spark, d):
    """Daily features computed by a streaming query that runs to the end of its input; equal to the batch."""
    out, mark = fresh_folder(spark, "stream-features"), fresh_folder(spark, "stream-features-checkpoint")
    _drained(spark, d, lambda features: windows.store_stream(features, out, mark, availableNow=True))
    stored = spark.read.schema(features.window_features(_txns(spark, d), "1 day").schema).parquet(out)
    return _rounded(stored, "decline_ratio", "avg_amount").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query
def stream_scoring(spark, d):
    """Live events scored by a streaming query into the alert table, then read back."""
    columns = views.live_event_columns()
    stream = messages.as_messages(_event_stream(spark, d).selectExpr(*columns))
    out, mark = fresh_folder(spark, "stream-alerts"), fresh_folder(spark, "stream-alerts-checkpoint")
    scoring.start_scoring(stream, fixed_forest(), out, mark, as_expression=True, availableNow=True).awaitTermination()
    found = read_alerts(spark, out)
    return _rounded(found, "anomaly_score").select(
        F.get_json_object("payload_json", "$.transaction_id").alias("transaction_id"), "merchant_id", "source", "anomaly_score")


@query
def stream_window_alerts(spark, d):
    """Daily windows of the stream scored by a model fitted on the stored features."""
    model = IsolationForest(WINDOW_FEATURES, key=("merchant_id", "timestamp")).fit(cut_lineage(_day_features(spark, d)))
    out, mark = fresh_folder(spark, "window-alerts"), fresh_folder(spark, "window-alerts-checkpoint")
    _drained(spark, d, lambda features: windows.start_window_alerts(features, model, out, mark, availableNow=True))
    return _rounded(read_alerts(spark, out).drop("detected_at"), "anomaly_score")


def _ledger(spark, d) -> DataFrame:
    """Ledger of the deliveries, in two arrivals: a twentieth of them comes behind all others, with repeats of a tenth.

    A row without ids ends the input: in its batch the timers take out the windows that are still open.
    """
    events = views.table(spark, d, "events").selectExpr(*views.delivery_columns())
    source, out, mark = fresh_folder(spark, "deliveries"), fresh_folder(spark, "ledger"), fresh_folder(spark, "ledger-checkpoint")
    behind, again = F.col("number") % 20 == 7, F.col("number") % 10 == 3
    end = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema])
    for part in (events.filter(~behind), events.filter(behind | again), end):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        rows = ledger.ledger_rows(stream, "1 day", "1 day", quiet_seconds=0, shard=F.col("number") % 4)
        ledger.start_ledger(rows, out, mark, availableNow=True).awaitTermination()
    return ledger.read_ledger(spark, out)


@query
def stream_ledger_balance(spark, d):
    """Live deliveries: what came in came out as an event, a duplicate or a late row."""
    return ledger.ledger_balance(_ledger(spark, d))


@query
def stream_ledger_alerts(spark, d):
    """Windows of live deliveries that were nearly all unauthorised, or overloaded."""
    windows = cut_lineage(ledger.live_windows(_ledger(spark, d)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))
    failures, overloads = ledger.live_auth_failures(windows, 0.5, 2), ledger.live_overloads(windows, 1.0, 0.25)
    return failures.select("merchant_id", "window_start", F.lit("unauthorized").alias("what"), F.col("unauthorized").alias("hits"), "logs").unionByName(
        overloads.join(windows.select("merchant_id", "window_start", "logs"), ["merchant_id", "window_start"]).select(
            "merchant_id", "window_start", F.lit("overloaded").alias("what"), F.col("overloaded").alias("hits"), "logs"))
