import pytest
from pyspark.sql import functions as F

from helpers import make_txns, utc
from ledgerpulse import schemas
from ledgerpulse.functions.expressions import ISSUER_DOWN_CODE, RISK_BLOCK_CODE
from ledgerpulse.operators import detectors, evaluation, features, quality


def logs_for(spark, rows, status=200, attempts=1, latency=100):
    return spark.createDataFrame([("WH" + r[0], r[0], r[2], "payment.success", status, attempts, latency) for r in rows],
                                 schemas.WEBHOOK_LOGS)


def test_window_features(txn_frame):
    rows = make_txns(60) + make_txns(20, status="DECLINED", code=RISK_BLOCK_CODE, amount=3.0, prefix="D")
    out = features.window_features(txn_frame(rows)).collect()
    assert len(out) == 1 and list(out[0].asDict()) == ["merchant_id", "timestamp", *schemas.WINDOW_FEATURES]
    row = out[0]
    assert (row.total_transactions, row.decline_count, row.risk_block_count) == (80, 20, 20)
    assert row.decline_ratio == 0.25 and row.avg_amount == pytest.approx((60 * 1500 + 20 * 3) / 80)


def test_features_edge_cases(txn_frame):
    rows = make_txns(5)
    bad = [("X", None, rows[0][2], 1.0, "INR", "SUCCESS", None, "4"), ("Y", "m", None, 1.0, "INR", "SUCCESS", None, "4"),
           (None, "only_null_ids", rows[0][2], 1.0, "INR", "SUCCESS", None, "4")]
    df = txn_frame(rows + bad)
    assert {r.merchant_id for r in features.window_features(df).collect()} == {"merchant_id_1"}
    assert features.window_features(df.drop("decline_code")).first().risk_block_count == 0
    empty = features.window_features(df.limit(0))
    assert empty.isEmpty() and empty.columns == ["merchant_id", "timestamp", *schemas.WINDOW_FEATURES]
    assert features.reduced_features(df).columns == ["merchant_id", *schemas.REDUCED_FEATURES]
    text = df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    assert features.window_features(text).count() == 1


def test_risk_block_spike(txn_frame):
    df = txn_frame(make_txns(50, status="DECLINED", code=RISK_BLOCK_CODE, seconds=590) + make_txns(49, "merchant_id_7", "DECLINED", RISK_BLOCK_CODE))
    assert [(r.merchant_id, r.risk_blocks) for r in detectors.risk_block_spikes(df).collect()] == [("merchant_id_1", 50)]


def test_auth_failures(spark, txn_frame):
    bad, good = make_txns(30, "merchant_id_2"), make_txns(30, "merchant_id_3")
    logs = logs_for(spark, bad, 401).unionAll(logs_for(spark, good, 200))
    found = detectors.auth_failures(txn_frame(bad + good), logs).collect()
    assert [(r.merchant_id, r.unauthorized, r.unauthorized_share) for r in found] == [("merchant_id_2", 30, 1.0)]


def test_card_testing(txn_frame):
    rows = (make_txns(95, "merchant_id_3", "DECLINED", "14_Invalid_Card_Number", 3.0, seconds=290)
            + make_txns(5, "merchant_id_3", amount=2.0, seconds=290, prefix="S") + make_txns(200, "merchant_id_4", amount=4.0))
    found = detectors.card_testing(txn_frame(rows)).collect()
    assert [(r.merchant_id, r.small_txns, r.declined_share) for r in found] == [("merchant_id_3", 100, 0.95)]


def test_issuer_outage(txn_frame):
    rows = []
    for m in range(4):
        rows += make_txns(9, f"m{m}", "DECLINED", ISSUER_DOWN_CODE, card_bin="411111") + make_txns(1, f"m{m}", prefix="S", card_bin="411111")
        rows += make_txns(30, f"m{m}", prefix="O", card_bin="424242")
    found = detectors.issuer_outages(txn_frame(rows)).collect()
    assert [(r.card_bin, r.txns, r.issuer_down) for r in found] == [("411111", 40, 36)]


def test_overload(spark, txn_frame):
    spike = make_txns(100, "merchant_id_4", start="2026-03-07T20:00:00", seconds=3500)
    calm = [r for h in range(5) for r in make_txns(5, "merchant_id_4", start=f"2026-03-07T0{h}:00:00", prefix=f"C{h}")]
    logs = logs_for(spark, spike, 504, 3, 9000).unionAll(logs_for(spark, calm))
    found = detectors.overloads(txn_frame(spike + calm), logs).collect()
    assert [(r.merchant_id, r.txns, r.overloaded, r.overload_share) for r in found] == [("merchant_id_4", 100, 100, 1.0)]


def test_reconciliation_gap_and_bulk_retry(small, spark):
    txns, logs = small[1], small[2]
    assert detectors.reconciliation_gaps(txns, logs).isEmpty()  # the crashed delivery belongs to a decline
    crashed = logs.withColumn("http_status", F.lit(500)).withColumn("delivery_attempts", F.lit(3))
    assert sorted(r.transaction_id for r in detectors.reconciliation_gaps(txns, crashed).collect()) == ["TXN-00000001", "TXN-00000003"]
    after = {r.log_id: r.http_status for r in detectors.bulk_retry(txns, crashed).collect()}
    assert after == {"WH-00000001": 200, "WH-00000002": 500, "WH-00000003": 200}


def test_injected_labels(txn_frame):
    rows = make_txns(120, start="2026-03-07T10:00:00") + make_txns(37, "m9", card_bin="411111", prefix="B")
    df = txn_frame(rows)
    first = detectors.tag_first(df, F.col("merchant_id") == "merchant_id_1", 50, "A1", status="DECLINED", decline_code=RISK_BLOCK_CODE)
    tagged = [r.transaction_id for r in first.filter("_anomaly_tag = 'A1'").collect()]
    assert sorted(tagged) == sorted(r[0] for r in rows[:50])
    share = detectors.tag_share(first, F.col("card_bin") == "411111", 0.9, "A4", "DECLINED", ISSUER_DOWN_CODE)
    assert share.filter("_anomaly_tag = 'A4'").count() == 34  # ceil(0.9 * 37)
    assert share.count() == 157
    both = detectors.tag_share(first, F.lit(True), 1.0, "A4", decline_code="x")
    assert both.filter("_anomaly_tag = 'A1'").count() == 50 and both.filter("decline_code = 'x'").count() == 157
    over = detectors.tag_first(first, F.col("status") == "DECLINED", 5, "A6", overwrite=True)
    assert over.filter("_anomaly_tag = 'A6'").count() == 5
    odd = first.withColumn("transaction_id", F.when(F.col("amount") % 2 < 1, F.lit("no digits at all")).otherwise(
        F.concat(F.lit("TXN-9"), F.lpad(F.regexp_extract("transaction_id", r"(\\d+)$", 1), 14, "9"))))
    assert detectors.tag_share(odd, F.lit(True), 1.0, "A4").filter("_anomaly_tag is null").isEmpty()
    assert detectors.tag_share(first, F.lit(False), 0.9, "A4").filter("_anomaly_tag = 'A4'").isEmpty()


def test_evaluation(spark):
    df = spark.createDataFrame(list(zip([1, 0, 1, 0, 1], [1, 0, 0, 1, 1])), "y_true int, y_pred int")
    counts = evaluation.confusion_counts(df.withColumn("model", F.lit("a")), "model")
    row = counts.first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 1)
    assert evaluation.confusion_matrix(counts).first().matrix == [[1, 1], [1, 2]]
    scores = evaluation.precision_recall_f1(counts).first()
    assert scores.precision == scores.recall == scores.f1 == pytest.approx(2 / 3)
    none = evaluation.precision_recall_f1(evaluation.confusion_counts(df.select((F.col("y_true") * 0).alias("y_true"), F.lit(0).alias("y_pred")))).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    models = [evaluation.confusion_counts(df.withColumn("model", F.lit(m)), "model") for m in "abcde"]
    table = evaluation.precision_recall_f1(models[0].unionAll(models[1]).unionAll(models[2]).unionAll(models[3]).unionAll(models[4]))
    long = evaluation.metrics_long(table)
    assert long.count() == 15 and long.columns == ["model", "metric", "score"]
    pivot = evaluation.metrics_pivot(long)
    assert pivot.count() == 5 and pivot.columns == ["model", "Precision", "Recall", "F1-Score"]
    assert evaluation.best_model(table).first().model == "a"


def test_quality_report_finds_violations(small):
    merchants, txns, logs = small
    clean = {r.check_name: r.violations for r in quality.quality_report(merchants, txns, logs).collect()}
    assert all(v == 0 for v in clean.values()) and len(clean) == 15
    broken = txns.unionAll(txns.limit(1)).withColumn("currency", F.lit(None).cast("string"))
    found = {r.check_name: r.violations for r in quality.quality_report(merchants, broken, logs).collect()}
    assert found["duplicate_transaction_id"] == 1 and found["currency_domain"] == 4


def test_error_code_rule(spark):
    df = spark.createDataFrame([("FAILED", "X"), ("SUCCESS", None), ("SUCCESS", "X")], "status string, error_code string")
    assert quality.error_code_only_when_failed(df).first().violations == 1
