"""Live deliveries: late and repeated rows are kept apart, windows add up to the batch."""
from datetime import timedelta

from pyspark.sql import functions as F

from helpers import utc
from ledgerpulse.streaming import ledger

SCHEMA = "transaction_id string, merchant_id string, timestamp timestamp, http_status int, latency_ms int"
START = utc("2026-03-07T10:00:00")


def delivery(name, minute, status=200, latency=100, merchant="m"):
    return (name, merchant, START + timedelta(minutes=minute), status, latency)


def run(spark, folder, parts, **options):
    """Each part arrives on its own; then the clock is flushed by a row that cannot be placed."""
    for part in [*parts, [(None, None, None, None, None)]]:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        rows = ledger.ledger_rows(stream, "10 minutes", "5 minutes", quiet_seconds=0, shard=F.lit(0), **options)
        ledger.start_ledger(rows, f"{folder}/out", f"{folder}/mark", availableNow=True).awaitTermination()
    return ledger.read_ledger(spark, f"{folder}/out")


def test_every_row_comes_out_once(spark, tmp_path):
    first = [delivery(f"T{i}", i, 401 if i < 10 else 504, 9000) for i in range(30)] + [delivery("T3", 3), (None, "m", START, 200, 1)]
    second = [delivery("T29", 29), delivery("LATE", 12), delivery("NEW", 31, 200), delivery("OTHER", 1, None, None, "n"), delivery("EDGE", 24)]
    found = run(spark, str(tmp_path), [first, second]).cache()
    kinds = {(r.transaction_id, r.kind) for r in found.filter("kind <> 'window'").collect()}
    assert kinds == {(f"T{i}", "event") for i in range(30)} | {("T3", "duplicate"), ("T29", "duplicate"), ("LATE", "late"),
                                                              ("NEW", "event"), ("OTHER", "event"), ("EDGE", "event")}
    balance = {r.merchant_id: tuple(r)[1:] for r in ledger.ledger_balance(found).collect()}
    assert balance == {"m": (35, 32, 2, 1), "n": (1, 1, 0, 0)}
    windows = ledger.live_windows(found)
    totals = {(r.merchant_id, (r.window_start.hour, r.window_start.minute)): (r.txns, r.logs, r.unauthorized, r.overloaded) for r in windows.collect()}
    assert totals == {("m", (10, 0)): (10, 10, 10, 0), ("m", (10, 10)): (10, 10, 0, 10), ("m", (10, 20)): (11, 11, 0, 10),
                      ("m", (10, 30)): (1, 1, 0, 0), ("n", (10, 0)): (1, 0, 0, 0)}
    assert [(r.merchant_id, r.window_start.minute) for r in ledger.live_auth_failures(windows).collect()] == [("m", 0)]
    assert sorted(r.window_start.minute for r in ledger.live_overloads(windows, volume_factor=1.0).collect()) == [10, 20]


def test_nothing_stored_yet(spark, tmp_path):
    assert ledger.read_ledger(spark, str(tmp_path / "none")).count() == 0
    assert ledger.live_windows(ledger.read_ledger(spark, str(tmp_path / "none"))).count() == 0


class OneValue:
    """The state of a key as the task sees it; counts how often it is fetched and stored."""

    def __init__(self, held=None, now=1_000, hasTimedOut=False):
        self.held, self.now, self.hasTimedOut, self.stored, self.timeout = held, now, hasTimedOut, 0, None

    exists = property(lambda self: self.held is not None)
    get = property(lambda self: self.held)

    def update(self, value):
        self.held, self.stored = value, self.stored + 1

    def setTimeoutDuration(self, ms):
        self.timeout = ms

    def getCurrentProcessingTimeMs(self):
        return self.now


def test_the_state_is_stored_once_however_many_rows_come():
    import pandas as pd

    judge = ledger.LedgerProcessor(600, 300, 10_000, 0, 5000)
    part = pd.DataFrame({"transaction_id": [f"T{i}" for i in range(20_000)], "at": 60, "http_status": 200, "latency_ms": [None] * 20_000})
    state = OneValue()
    out = pd.concat(judge(("m", 0), iter([part, part.head(5)]), state))
    assert state.stored == 1 and out["kind"].value_counts().to_dict() == {"event": 20_000, "duplicate": 5}
    state = OneValue(state.held, now=2_000, hasTimedOut=True)
    out = pd.concat(judge(("m", 0), iter([]), state))
    assert out[["kind", "window_start", "txns", "logs"]].values.tolist() == [["window", 0, 20_000, 20_000]]
    assert state.timeout == 9_000  # comes back when the transactions are forgotten
    state = OneValue(state.held, now=11_000, hasTimedOut=True)
    assert list(judge(("m", 0), iter([]), state)) == [] and state.held == (60, [], [], [], []) and state.timeout is None
    late = judge(("m", 0), iter([part.head(1).assign(at=-241), part.head(1)]), OneValue(state.held, now=12_000))
    assert pd.concat(late)["kind"].tolist() == ["late", "event"]
