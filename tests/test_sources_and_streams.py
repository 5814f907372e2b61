import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import make_txns
from ledgerpulse import schemas
from ledgerpulse.operators import alerts, retrieval
from ledgerpulse.operators.features import window_features
from ledgerpulse.operators.iforest import IsolationForest, fixed_forest
from ledgerpulse.sources import alert_table, files, messages
from ledgerpulse.streaming import notify, scoring, windows


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_csv_keeps_codes_as_text(spark, small, tmp_path):
    merchants, txns, logs = small
    for name, df in (("merchants", merchants), ("transactions", txns.withColumn("_anomaly_tag", F.lit("x"))), ("webhook_logs", logs)):
        files.write_csv(df.coalesce(1), str(tmp_path / f"{name}.csv"))
    tables = files.TelemetryTables(spark, str(tmp_path))
    assert tables.transactions.columns == schemas.TRANSACTIONS.names
    assert sorted(r.card_bin for r in tables.transactions.collect()) == ["400011", "411111", "424242"]
    assert tables.merchants.filter("mcc_code = '5411'").count() == 1
    assert tables.transactions.exceptAll(txns).isEmpty() and tables.webhook_logs.exceptAll(logs).isEmpty()
    loaded = files.load_transactions(spark, str(tmp_path / "transactions.csv"))
    assert dict(loaded.dtypes)["timestamp"] == "timestamp" and loaded.count() == 3


def test_missing_files(spark, tmp_path):
    tables = files.TelemetryTables(spark, str(tmp_path))
    assert tables.transactions.isEmpty() and tables.transactions.schema == schemas.TRANSACTIONS
    with pytest.raises(FileNotFoundError):
        files.load_transactions(spark, str(tmp_path / "none.csv"))
    (tmp_path / "bad.csv").write_text("transaction_id,amount\nT1,5\n")
    with pytest.raises(ValueError, match="missing required columns.*merchant_id"):
        files.load_transactions(spark, str(tmp_path / "bad.csv"))
    with pytest.raises(FileNotFoundError):
        files.load_table(spark, str(tmp_path / "none"), "a int")


def test_frames_can_be_handed_in(spark, small):
    tables = files.TelemetryTables(spark, merchants=small[0], transactions=small[1], webhook_logs=small[2])
    assert tables.transactions is small[1]
    assert files.TelemetryTables(spark).merchants.isEmpty()


def test_columns_in_any_order(spark, tmp_path):
    (tmp_path / "t.csv").write_text("status,amount,timestamp,merchant_id,transaction_id,note\nSUCCESS,5.5,2026-03-07T10:00:00+00:00,m,T1,hi\n")
    row = files.load_transactions(spark, str(tmp_path / "t.csv")).first()
    assert (row.status, row.amount, row.merchant_id, row.note) == ("SUCCESS", 5.5, "m", "hi")


def test_markdown_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_markdown(spark, str(tmp_path / "docs"))
    (tmp_path / "docs" / "deep").mkdir(parents=True)
    (tmp_path / "docs" / "x.txt").write_text("no")
    with pytest.raises(ValueError):
        files.read_markdown(spark, str(tmp_path / "docs"))
    (tmp_path / "docs" / "a.md").write_text("# Ä\n\nline", encoding="utf-8")
    (tmp_path / "docs" / "deep" / "b.md").write_text("b")
    rows = files.read_markdown(spark, str(tmp_path / "docs")).collect()
    assert sorted((os.path.basename(r.source), r.text) for r in rows) == [("a.md", "# Ä\n\nline"), ("b.md", "b")]


def test_chunk_table_is_stored_and_reloaded(spark, tmp_path):
    docs = spark.createDataFrame([("a.md", "word " * 300)], "source string, text string")
    chunks = retrieval.chunk_documents(docs)
    files.save_table(chunks, str(tmp_path / "chunks"))
    again = files.load_table(spark, str(tmp_path / "chunks"), chunks.schema)
    assert again.count() > 1 and again.exceptAll(chunks).isEmpty()


def test_ingest(spark):
    good = [{"transaction_id": "TXN-ABC123", "merchant_id": "MERCH-001", "amount": 1500.5, "status": "SUCCESS", "metadata": {"gateway": "g1"}},
            {"transaction_id": "TXN-FAIL999", "merchant_id": "MERCH-002", "amount": 500.0, "status": "FAILED", "error_code": "INSUFFICIENT_FUNDS", "currency": "USD"}]
    bad = [{"transaction_id": "TXN-BAD", "merchant_id": "MERCH-003", "amount": 100.0}, {"merchant_id": "m", "amount": 1, "status": "S"},
           {"transaction_id": "t", "merchant_id": "m", "amount": 0, "status": "S"}, {"transaction_id": "t", "merchant_id": "m", "status": "S"}]
    texts = [json.dumps(x) for x in good + bad] + ["not json", None]
    parsed = messages.parse_ingest(spark.createDataFrame([(t,) for t in texts], "value string"))
    accepted = {r.transaction_id: r for r in messages.accepted(parsed).collect()}
    assert accepted["TXN-ABC123"].currency == "INR" and accepted["TXN-ABC123"].metadata == {"gateway": "g1"}
    assert accepted["TXN-FAIL999"].currency == "USD" and accepted["TXN-FAIL999"].error_code == "INSUFFICIENT_FUNDS"
    assert accepted["TXN-ABC123"].message == "Payment event for transaction TXN-ABC123 acknowledged."
    problems = sorted(r.problem for r in messages.rejected(parsed).collect())
    assert problems == sorted(["status missing", "transaction_id missing", "amount must be greater than 0", "amount missing",
                               "not a JSON object", "not a JSON object"])


def test_alert_table(spark, small, tmp_path):
    path = str(tmp_path / "alerts")
    assert alert_table.read_alerts(spark, path).isEmpty()
    one = spark.sql("""select 'batch' as source, 'merchant_id_1' as merchant_id, timestamp'2026-03-07 10:00:00' as detected_at,
        cast(null as timestamp) as window_start, 't' as alert_type, 'spike' as description, cast(null as double) as anomaly_score,
        named_struct('decline_ratio', 0.5D, 'total_transactions', 3L) as metrics, cast(null as string) as payload_json""")
    alert_table.append_alerts(one, path)
    alert_table.append_alerts(one.withColumn("description", F.lit("again")), path)
    stored = alert_table.read_alerts(spark, path)
    lines = sorted(r.message for r in alerts.alert_messages(small[0], stored).collect())
    assert lines == ["ALERT FOUND: [2026-03-07T10:00:00Z] - again", "ALERT FOUND: [2026-03-07T10:00:00Z] - spike",
                     "No active ML alerts for merchant_id_2."]
    assert alerts.alerts_since(stored, None).count() == 2
    assert alerts.alerts_since(stored, stored.first().detected_at).isEmpty()


def live_rows(n=40):
    return [{"transaction_id": f"TXN-STREAM-{i}", "merchant_id": f"m{i % 3}", "timestamp": "2026-03-07T10:00:00Z", "amount": 10.0 + i,
             "currency": "INR", "status": "DECLINED" if i % 10 == 0 else "SUCCESS", "decline_code": "93_Risk_Block" if i % 10 == 0 else None,
             "webhook_http_status": 401 if i % 10 == 1 else 200, "event_type": "e", "anomaly_type": None} for i in range(n)]


def test_scoring_stream_equals_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines = [json.dumps(r) for r in live_rows()] + ["broken {"]
    (inbox / "a.json").write_text("\n".join(lines[:20]))
    (inbox / "b.json").write_text("\n".join(lines[20:]))
    model = fixed_forest()
    batch = scoring.score_events(spark.createDataFrame([(x,) for x in lines], "value string"), model)
    flagged = sorted(r.transaction_id for r in batch.filter("prediction = 1").collect())
    assert flagged == sorted(f"TXN-STREAM-{i}" for i in range(40) if i % 10 in (0, 1))
    assert batch.filter("bad_timestamp").count() == 1
    out, mark = str(tmp_path / "alerts"), str(tmp_path / "mark")
    def run():
        source = messages.raw_messages(spark, "files", str(inbox), max_files_per_trigger=1)
        drain(scoring.start_scoring(source, model, out, mark, availableNow=True))
        return sorted(json.loads(r.payload_json)["transaction_id"] for r in alert_table.read_alerts(spark, out).collect())
    assert run() == flagged
    assert run() == flagged  # nothing is scored twice after a restart
    assert alert_table.read_alerts(spark, out).filter("anomaly_score < 0 and source = 'stream'").count() == 8


def test_repeated_batch_is_stored_once(spark, tmp_path):
    write = alert_table.append_batch_once(str(tmp_path / "a"), "w")
    rows = alerts.empty_alerts(spark).unionAll(spark.createDataFrame(
        [("s", "m", None, None, "t", "d", 0.1, None, "{}")], schemas.ALERTS))
    write(rows, 0)
    write(rows, 0)
    write(rows, 1)
    assert alert_table.read_alerts(spark, str(tmp_path / "a")).count() == 2
    alert_table.append_batch_once(str(tmp_path / "a"), alert_table.writer_of("w", "other/checkpoint"))(rows, 0)
    assert alert_table.read_alerts(spark, str(tmp_path / "a")).count() == 3  # a second writer takes nothing away


@pytest.mark.parametrize("files", [1, 3])
def test_events_in_a_folder_are_streamed_in_full(spark, tmp_path, files):
    from ledgerpulse.plans import catalog

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(300)
    events.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    expected = catalog.features_1day(spark, str(tmp_path)).collect()
    assert sorted(map(str, catalog.stream_features(spark, str(tmp_path)).collect())) == sorted(map(str, expected))


def test_one_file_per_trigger_loses_nothing(spark, txn_frame, tmp_path):
    rows = [r for h in (13, 10, 12) for r in make_txns(30, f"m{h}", start=f"2026-03-07T{h}:00:00", seconds=3600)]
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for part in (rows[:30], rows[30:60], rows[60:]):
        txn_frame(part).coalesce(1).write.mode("append").parquet(inbox)
    source = spark.readStream.schema(schemas.TRANSACTIONS).option("maxFilesPerTrigger", 1).parquet(inbox)
    bounded = windows.BoundedInput(source, str(tmp_path / "end"))
    bounded.drain(lambda s: windows.store_stream(windows.streaming_features(s, "10 minutes", windows.WHOLE_INPUT), out, mark, availableNow=True))
    batch = window_features(txn_frame(rows))
    assert sorted(map(str, spark.read.schema(batch.schema).parquet(out).collect())) == sorted(map(str, batch.collect()))


def test_window_stream_equals_batch_for_closed_windows(spark, txn_frame, tmp_path):
    rows = [r for h in range(10, 14) for r in make_txns(30, f"m{h % 2}", start=f"2026-03-07T{h}:00:00", seconds=3600)]
    late = make_txns(5, "late", start="2026-03-07T08:00:00")
    inbox = str(tmp_path / "in")
    txn_frame(rows).coalesce(1).write.parquet(inbox)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        stream = spark.readStream.schema(schemas.TRANSACTIONS).parquet(inbox)
        features = windows.streaming_features(stream, "10 minutes", "10 minutes")
        drain(windows.store_stream(features, out, mark, availableNow=True))
        return spark.read.schema(features.schema).parquet(out)
    got = run()
    batch = window_features(txn_frame(rows)).filter("timestamp < timestamp'2026-03-07 13:40:00'")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    txn_frame(late).coalesce(1).write.mode("append").parquet(inbox)
    assert run().filter("merchant_id = 'late'").isEmpty()  # behind the watermark


def test_window_alerts_and_notice(spark, txn_frame, tmp_path):
    rows = make_txns(400, "m0", seconds=7000) + make_txns(80, "m1", "DECLINED", "93_Risk_Block", 2.0, start="2026-03-07T10:00:00", seconds=500)
    inbox, out = str(tmp_path / "in"), str(tmp_path / "alerts")
    txn_frame(rows).coalesce(1).write.parquet(inbox)
    model = IsolationForest(schemas.WINDOW_FEATURES, contamination=0.1).fit(window_features(txn_frame(rows)))
    stream = windows.streaming_features(spark.readStream.schema(schemas.TRANSACTIONS).parquet(inbox))
    drain(windows.start_window_alerts(stream, model, out, str(tmp_path / "mark"), availableNow=True))
    found = alert_table.read_alerts(spark, out)
    assert found.filter("merchant_id = 'm1' and alert_type = 'High Risk Block Spike'").count() == 1
    seen = []
    def look():
        drain(notify.start_notifications(spark, out, str(tmp_path / "seen"), seen.append, availableNow=True))
    look()
    look()
    assert sum(seen) == found.count() and len([n for n in seen if n]) == len(seen)


def test_source_kinds(spark, tmp_path):
    with pytest.raises(ValueError):
        messages.raw_messages(spark, "files")
    with pytest.raises(ValueError):
        messages.raw_messages(spark, "smoke")
    df = spark.createDataFrame([("a", None)], "x string, y int")
    messages.publish(df, "files", str(tmp_path / "out"))
    messages.publish(df, "files", str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"x":"a","y":null}'] * 2
    with pytest.raises(ValueError):
        messages.publish(df, "smoke")


def test_shared_folder_comes_from_the_session(spark):
    from types import SimpleNamespace

    from ledgerpulse.session import checkpoint_root, fresh_folder
    assert checkpoint_root(spark) == checkpoint_root(spark)  # a temporary one, in local mode
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs:///shared/"}[key]))
    assert checkpoint_root(named) == "hdfs:///shared/"
    assert fresh_folder(named, "a").startswith("hdfs:///shared/a-") and fresh_folder(named, "a") != fresh_folder(named, "a")
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                              sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    chosen = SimpleNamespace(conf=cluster.conf, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: "hdfs:///own"))
    assert checkpoint_root(chosen) == "hdfs:///own"
    with pytest.raises(RuntimeError):
        checkpoint_root(cluster)
