"""Constants and rows that several test modules share."""
from datetime import datetime, timedelta, timezone

SF = "/root/testdata/sf0.001"


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def make_txns(n=60, merchant="merchant_id_1", status="SUCCESS", code=None, amount=1500.0,
              start="2026-03-07T10:00:00", seconds=600, prefix="TXN", card_bin="424242"):
    begin = utc(start)
    return [(f"{prefix}-{merchant}-{i:06d}", merchant, begin + timedelta(seconds=seconds * i / n), amount, "INR",
             status, code, card_bin) for i in range(n)]
