import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from helpers import utc  # noqa: E402
from ledgerpulse import schemas  # noqa: E402
from ledgerpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Two merchants, three transactions, one log each."""
    merchants = spark.createDataFrame([
        ("merchant_id_1", "Acme Payments Ltd.", "5812", "https://hooks.acme.com/payment/events"),
        ("merchant_id_2", "Beta Commerce Pvt.", "5411", "https://hooks.beta.com/payment/events")], schemas.MERCHANTS)
    transactions = spark.createDataFrame([
        ("TXN-00000001", "merchant_id_1", utc("2026-03-07T10:00:00"), 1500.0, "INR", "SUCCESS", None, "424242"),
        ("TXN-00000002", "merchant_id_1", utc("2026-03-07T10:01:00"), 800.0, "INR", "DECLINED", "51_Insufficient_Funds", "400011"),
        ("TXN-00000003", "merchant_id_2", utc("2026-03-07T10:02:00"), 200.0, "INR", "SUCCESS", None, "411111")],
        schemas.TRANSACTIONS)
    logs = spark.createDataFrame([
        ("WH-00000001", "TXN-00000001", utc("2026-03-07T10:00:05"), "payment.success", 200, 1, 120),
        ("WH-00000002", "TXN-00000002", utc("2026-03-07T10:01:05"), "payment.failed", 500, 3, 9800),
        ("WH-00000003", "TXN-00000003", utc("2026-03-07T10:02:05"), "payment.success", 401, 2, 300)],
        schemas.WEBHOOK_LOGS)
    return merchants, transactions, logs


def _kpi_rows():
    txns = [("TXN-001", "m1", "10:00", 100.0, "SUCCESS", None), ("TXN-002", "m1", "11:00", 200.0, "DECLINED", "51_Insufficient_Funds"),
            ("TXN-003", "m2", "10:30", 150.0, "SUCCESS", None), ("TXN-004", "m2", "12:00", 50.0, "DECLINED", "93_Risk_Block")]
    logs = [("WH-001", "TXN-001", 200, 1, 120), ("WH-002", "TXN-002", 500, 3, 1500),
            ("WH-003", "TXN-003", 200, 1, 80), ("WH-004", "TXN-004", 404, 2, 950)]
    return txns, logs


def _frames(spark, txns, logs):
    at = lambda hm: utc(f"2025-06-01T{hm}:00")
    times = {t[0]: t[2] for t in txns}
    return (
        spark.createDataFrame([(i, m, at(hm), a, "INR", s, c, "424242") for i, m, hm, a, s, c in txns], schemas.TRANSACTIONS),
        spark.createDataFrame([(w, t, at(times[t]), "payment.success", h, n, ms) for w, t, h, n, ms in logs], schemas.WEBHOOK_LOGS))


@pytest.fixture(scope="session")
def kpi_tables(spark):
    return _frames(spark, *_kpi_rows())


@pytest.fixture(scope="session")
def comparison_tables(spark):
    txns, logs = _kpi_rows()
    txns += [("TXN-005", "m1", "13:00", 300.0, "SUCCESS", None), ("TXN-006", "m2", "14:00", 75.0, "SUCCESS", None)]
    logs += [("WH-005", "TXN-005", 401, 1, 200), ("WH-006", "TXN-006", 200, 1, 150)]
    return _frames(spark, txns, logs)


@pytest.fixture(scope="session")
def txn_frame(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.TRANSACTIONS)
