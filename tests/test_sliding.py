"""Bursts across the clock's windows."""
import random

import pytest
from pyspark.sql import functions as F

from helpers import make_txns, utc
from ledgerpulse import schemas
from ledgerpulse.operators import detectors, sliding


@pytest.mark.parametrize("window, seconds", [("10 minutes", 600), ("1 second", 1), ("2 hours", 7200), ("1 day", 86400)])
def test_window_seconds(window, seconds):
    assert sliding.window_seconds(window) == seconds
    with pytest.raises(ValueError):
        sliding.window_seconds("0 minutes")


def test_a_burst_across_a_boundary_is_found(txn_frame):
    rows = make_txns(50, status="DECLINED", code="93_Risk_Block", start="2026-03-07T10:05:00", seconds=590)
    rows += make_txns(49, merchant="merchant_id_2", status="DECLINED", code="93_Risk_Block", start="2026-03-07T10:05:00", seconds=590)
    txns = txn_frame(rows)
    assert detectors.risk_block_spikes(txns).count() == 0  # 26 and 24 in the two halves
    found = sliding.risk_block_bursts(txns).collect()
    assert [(r.merchant_id, r.windows, r.peak_risk_blocks) for r in found] == [("merchant_id_1", 1, 50)]


def test_card_testing_and_issuer_outage_across_a_boundary(txn_frame):
    small = make_txns(120, status="DECLINED", code="14_Invalid_Card_Number", amount=2.0, start="2026-03-07T10:02:30", seconds=290)
    down = make_txns(24, merchant="merchant_id_7", status="DECLINED", code="91_Issuer_Switch_Inoperative", start="2026-03-07T11:00:00", seconds=7100, card_bin="400011")
    fine = make_txns(24, merchant="merchant_id_7", start="2026-03-07T13:00:00", seconds=7000, card_bin="400011", prefix="OK")
    early = make_txns(24, merchant="merchant_id_7", start="2026-03-07T08:50:00", seconds=7000, card_bin="400011", prefix="EARLY")
    txns = txn_frame(small + down + fine + early)
    assert detectors.card_testing(txns).count() == 0 and detectors.issuer_outages(txns.filter("card_bin = '400011'")).count() == 0
    assert [r.merchant_id for r in sliding.card_testing_bursts(txns).collect()] == ["merchant_id_1"]
    assert [r.card_bin for r in sliding.issuer_outage_bursts(txns).collect()] == ["400011"]


def test_deliveries_across_a_boundary(spark, txn_frame):
    txns = make_txns(12, start="2026-03-07T11:10:00", seconds=6000) + make_txns(60, merchant="merchant_id_2", start="2026-03-07T10:30:00", seconds=3500)
    txns += make_txns(30, merchant="merchant_id_2", start="2026-03-01T00:00:00", seconds=86400, prefix="OLD")
    logs = [(f"WH-{t[0]}", t[0], t[2], "payment.failed", 401 if t[1] == "merchant_id_1" else 504 if "OLD" not in t[0] else 200, 3, 9000) for t in txns]
    logs += [("WH-ok-1", "OK-1", utc("2026-03-07T09:50:00"), "payment.success", 200, 1, 50), ("WH-ok-2", "OK-2", utc("2026-03-07T13:59:00"), "payment.success", 200, 1, 50)]
    txns += [(t, "merchant_id_1", utc(at), 10.0, "INR", "SUCCESS", None, "424242") for t, at in (("OK-1", "2026-03-07T10:01:00"), ("OK-2", "2026-03-07T13:58:00"))]
    txns, logs = txn_frame(txns), spark.createDataFrame(logs, schemas.WEBHOOK_LOGS)
    found = sliding.auth_failure_bursts(txns, logs).collect()
    assert [(r.merchant_id, r.peak_unauthorized) for r in found] == [("merchant_id_1", 12)]
    found = {r.merchant_id: r for r in sliding.overload_bursts(txns, logs, volume_factor=3.0).collect()}
    assert set(found) == {"merchant_id_2"} and found["merchant_id_2"].peak_txns == 60


@pytest.mark.parametrize("buckets", [1, 8])
def test_totals_equal_brute_force(spark, monkeypatch, buckets):
    monkeypatch.setattr(sliding, "BUCKET_WINDOWS", buckets)
    draw = random.Random(1)
    at = [draw.randrange(0, 400) for _ in range(300)] + [77] * 100 + [-3, -1, 0]
    rows = [("hot" if i % 3 else "cold", t, i % 5) for i, t in enumerate(at)] + [(None, 5, 1), ("cold", None, 1)]
    events = spark.createDataFrame(rows, "k string, t long, v int").withColumn("timestamp", F.timestamp_seconds(F.col("t") + F.lit(0.25)))
    mine = {(r.k, r["at"]): (r.n, r.v) for r in sliding.sliding_totals(events, "k", {"n": F.lit(1), "v": F.col("v")}, "10 seconds").collect()}
    whole = [r for r in rows if r[0] and r[1] is not None]
    assert mine == {(k, t): (sum(a == k and t - 10 < b <= t for a, b, _ in whole), sum(v for a, b, v in whole if a == k and t - 10 < b <= t)) for k, t, _ in whole}


def test_windows_that_touch_are_one_burst(spark):
    rows = [("a", t) for t in (0, 10, 21, 22)]
    events = spark.createDataFrame(rows, "k string, t long").withColumn("timestamp", F.timestamp_seconds("t"))
    totals = sliding.sliding_totals(events, "k", {"n": F.lit(1)}, "10 seconds")
    found = sliding.bursts(totals, "k", F.col("n") >= 1, "10 seconds", ["n"]).orderBy("burst_start").collect()
    assert [(r.burst_start.second, r.burst_end.second, r.windows, r.peak_n) for r in found] == [(51, 10, 2, 1), (12, 22, 2, 2)]


def test_a_full_day_takes_one_step_per_second(spark):
    """A frame that moves is summed anew for every row: a day of seconds would be 86,400 sums of up to 86,400 rows."""
    events = spark.range(0, 3 * 86_400, 2).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("timestamp"))
    totals = sliding.sliding_totals(events, "k", {"n": F.lit(1)}, "1 day")
    plan = totals._jdf.queryExecution().analyzed().toString()
    assert "unboundedpreceding" in plan and "RangeFrame, -" not in plan
    assert totals.filter(F.col("n") != F.least(F.floor(F.col("at") / 2) + 1, F.lit(43_200))).count() == 0 and totals.count() == 3 * 43_200
