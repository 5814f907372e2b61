import pytest
from pyspark.sql import functions as F

from helpers import utc
from ledgerpulse import schemas
from ledgerpulse.operators import joins, kpi, lookups, ranking, sets


def ids(df, column="transaction_id"):
    return [r[column] for r in df.collect()]


def test_find_by_key(small):
    merchants, txns, _ = small
    assert lookups.find_by_key(merchants, "merchant_id", "merchant_id_1").first()["mcc_code"] == "5812"
    assert lookups.find_by_key(merchants, "merchant_id", "nobody").isEmpty()
    assert lookups.find_by_key(merchants, "merchant_id", "").isEmpty()
    assert lookups.find_by_key(txns, "transaction_id", "TXN-00000002").first()["status"] == "DECLINED"
    assert lookups.find_by_key(merchants.union(merchants), "merchant_id", "merchant_id_1").count() == 1


@pytest.mark.parametrize("limit", [0, -1, 501, 2.5, True, "10"])
def test_limit_is_validated(limit):
    with pytest.raises(ValueError):
        lookups.checked_limit(limit)


def test_limit_default_and_bounds():
    assert lookups.checked_limit() == 10 and lookups.checked_limit(1) == 1 and lookups.checked_limit(500) == 500


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("a", float("nan"), 1), ("b", 2.0, 2)], "k string, x double, n int")
    assert [(r.k, r.x, r.n) for r in lookups.clean_records(df).orderBy("k").collect()] == [("a", None, 1), ("b", 2.0, 2)]


def test_defaults_only_for_absent_columns(small):
    _, txns, _ = small
    out = lookups.with_defaults(txns.drop("decline_code"), {"decline_code": "", "status": "x"})
    assert out.filter("decline_code = ''").count() == 3 and out.filter("status = 'x'").count() == 0


def test_update_leaves_other_rows(small, spark):
    logs = small[2]
    updates = spark.createDataFrame([("WH-00000002", 200), ("WH-404", 200)], "log_id string, new_http_status int")
    out = {r.log_id: r.http_status for r in lookups.update_http_status(logs, updates).collect()}
    assert out == {"WH-00000001": 200, "WH-00000002": 200, "WH-00000003": 401}
    assert ids(lookups.unmatched_updates(logs, updates), "log_id") == ["WH-404"]
    outcome = {r.log_id: r for r in lookups.retry_outcomes(updates, logs).collect()}
    assert outcome["WH-00000002"].success and outcome["WH-00000002"].new_http_status == 200
    assert not outcome["WH-404"].success and outcome["WH-404"].message == "Webhook log 'WH-404' not found."


def test_not_found_report(small, spark):
    asked = spark.createDataFrame([("merchant_id_1",), ("merchant_id_9",), ("merchant_id_9",)], "merchant_id string")
    assert ids(lookups.not_found(asked, small[0], "merchant_id"), "merchant_id") == ["merchant_id_9"]
    assert ids(lookups.find_all(asked, small[0], "merchant_id"), "merchant_id") == ["merchant_id_1"]


def test_first_log_per_transaction(small):
    logs = small[2].unionAll(small[2].withColumn("log_id", F.lit("WH-99999999")))
    first = lookups.first_per_key(logs, "transaction_id", "log_id")
    assert sorted(ids(first, "log_id")) == ["WH-00000001", "WH-00000002", "WH-00000003"]
    assert first.columns == logs.columns


def test_left_join_suffixes_and_rows(kpi_tables):
    joined = joins.transactions_with_logs(*kpi_tables)
    assert joined.count() == 4 and {"timestamp", "timestamp_wh", "http_status"} <= set(joined.columns)


def test_merged_view_with_empty_sides(kpi_tables):
    txns, logs = kpi_tables
    assert joins.merged_view(txns.limit(0), logs).columns == logs.columns
    assert joins.merged_view(txns, logs.limit(0)).columns == txns.columns
    assert joins.merged_view(txns.limit(0), logs.limit(0)).isEmpty()
    assert joins.merged_view(txns, logs).count() == 4


def test_details_hold_the_log_or_null(small):
    merchants, txns, logs = small
    rows = {r.transaction_id: r.webhook_log for r in
            joins.transaction_details(txns, logs.filter("log_id <> 'WH-00000003'")).collect()}
    assert rows["TXN-00000002"].http_status == 500 and rows["TXN-00000003"] is None


def test_left_join_of_any_keys_equals_plain_join(spark):
    left = spark.createDataFrame([(i, f"m{i % 3}") for i in range(6000)] + [(None, "m0")] * 2, "k int, m string")
    right = spark.createDataFrame([(7, 1)] * 500 + [(i % 5000, i) for i in range(15000)] + [(None, 3)], "k int, v int")  # equal rows, many hot keys
    plain = left.join(right, "k", "left")
    spread = joins.left_join_any_keys(left, right, "k")
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_join_starts_no_job_before_its_action(spark, kpi_tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "joins")
    joins.transactions_with_logs(*kpi_tables)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("rest", "")


def test_orphans(small):
    merchants, txns, logs = small
    found = {r.check_name: r.orphans for r in
             joins.orphan_counts(txns, logs.filter("log_id <> 'WH-00000001'"), merchants).collect()}
    assert found == {"txn_without_log": 1, "log_without_txn": 0, "txn_without_merchant": 0, "merchant_without_txn": 0}


def test_decline_knowledge_join(small):
    row = joins.decline_explanations(small[1]).first()
    assert (row.code, row.title) == ("51", "Insufficient Funds")


def test_newest_first_and_limits(small):
    merchants, txns, logs = small
    assert ids(ranking.recent_transactions(txns, "merchant_id_1")) == ["TXN-00000002", "TXN-00000001"]
    assert ids(ranking.recent_transactions(txns, "merchant_id_1", 1)) == ["TXN-00000002"]
    assert ids(ranking.recent_logs(txns, logs, "merchant_id_1"), "log_id") == ["WH-00000002", "WH-00000001"]
    assert ranking.recent_transactions(txns, "nobody").isEmpty()
    with pytest.raises(ValueError):
        ranking.recent_transactions(txns, "merchant_id_1", 501)
    assert ranking.retry_candidates_preview(txns, logs).count() == 3


def test_top_n_is_cut_before_the_shuffle(small):
    plan = ranking.recent_transactions_all(small[1], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sequential_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("t"), F.col("id").alias("k")).repartition(7)
    rows = ranking.sequential_ids(df, ["t"], start=5).orderBy("t").collect()
    assert [r.transaction_id for r in rows] == [f"TXN-{i + 5:08d}" for i in range(1000)]


def test_union_and_key_sets(small, spark):
    _, txns, logs = small
    more = txns.drop("card_bin").withColumn("transaction_id", F.lit("TXN-X"))
    both = sets.union_feeds(txns, more)
    assert both.count() == 6 and both.filter("card_bin is null").count() == 3
    assert sets.key_set_difference(txns, logs, "transaction_id").isEmpty()
    assert sets.is_subset(logs, both, "transaction_id") and not sets.is_subset(both, logs, "transaction_id")


def test_kpis(kpi_tables):
    txns, logs = kpi_tables
    assert kpi.success_rate(txns).first().success_rate == 50.0
    assert {r.merchant_id: r.success_rate for r in kpi.success_rate(txns, "merchant_id").collect()} == {"m1": 50.0, "m2": 50.0}
    assert kpi.webhook_success_rate(logs).first().webhook_success_rate == 50.0
    assert kpi.critical_failures(txns, logs).first().critical_failures == 2
    assert sorted(ids(kpi.failed_transactions(txns, logs))) == ["TXN-002", "TXN-004"]
    assert kpi.failed_transactions(txns, logs.limit(0)).count() == 2
    assert sorted(r.decline_code for r in kpi.decline_distribution(txns).collect()) == ["51_Insufficient_Funds", "93_Risk_Block"]
    assert kpi.decline_distribution(txns.filter("status = 'SUCCESS'")).isEmpty()
    assert kpi.success_rate(txns.limit(0)).first().success_rate == 0.0
    summary = kpi.table_summary(txns).first()
    assert (summary.row_count, summary.min_amount, summary.max_amount, summary.median_amount) == (4, 50.0, 200.0, 125.0)


def test_diagnostics_report(spark):
    merchants = spark.createDataFrame([("m", "x", "1", "u"), ("quiet", "x", "1", "u")], schemas.MERCHANTS)
    txns = spark.createDataFrame(
        [(f"T{i}", "m", utc(f"2026-01-01T00:0{i}:00"), 1.0, "INR", s, c, "4") for i, (s, c) in enumerate(
            [("SUCCESS", None), ("DECLINED", "93_Risk_Block"), ("DECLINED", "93_Risk_Block")])], schemas.TRANSACTIONS)
    logs = spark.createDataFrame([(f"W{i}", f"T{i}", utc(f"2026-01-01T00:0{i}:05"), "payment.failed", h, 1, 9)
                                  for i, h in enumerate([200, 401, 401])], schemas.WEBHOOK_LOGS)
    reports = {r.merchant_id: r.report for r in kpi.merchant_diagnostics(merchants, txns, logs).collect()}
    assert "Transaction breakdown: 1 SUCCESS, 2 DECLINED." in reports["m"]
    assert "93_Risk_Block: 2 occurrences" in reports["m"] and "HTTP 401: 2 deliveries" in reports["m"]
    assert reports["m"].splitlines()[-3].startswith("  • log_id=W2")
    assert "No decline codes recorded in this window." in reports["quiet"]
    assert "  (no webhook logs found)" in reports["quiet"] and reports["quiet"].endswith("  (none)")
