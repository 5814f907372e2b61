"""Live deliveries with keyed state: every row that comes in is accounted for.

A key is a merchant and one of `SHARDS` parts of its transactions, so a merchant that sends most rows is many keys, and a
repeated message always meets the key that saw it first. Per key the state remembers the transactions of a while (they
expire), the newest event time, and the totals of the windows that are still open. Each row comes out once, as

* `event`: accepted, and counted in its window,
* `duplicate`: its transaction was accepted before,
* `late`: older than the key's newest event time, as the batches before left it, less the allowed delay,

and the totals of windows come out as `window` rows: when the key's time has passed them, or when nothing has come for a while
(a timer). A window may come out in parts, from its shards or after a pause; `live_windows` sums them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerpulse.functions.expressions import safe_divide
from ledgerpulse.operators.sliding import window_seconds
from ledgerpulse.sources.files import path_exists

#: Parts of a merchant's transactions.
SHARDS = 16
_TOTALS = ["txns", "logs", "unauthorized", "overloaded"]
_ROW = ("kind string, merchant_id string, shard int, transaction_id string, at long, http_status int, latency_ms int, window_start long, "
        + ", ".join(f"{t} long" for t in _TOTALS))
_COLUMNS = [part.split()[0] for part in _ROW.split(", ")]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LedgerProcessor:
    """What becomes of the rows of one key; times are seconds since 1970.

    The state goes to the task and back with the rows, as one value per key: asking the store for each transaction by
    itself takes far longer than judging it.
    """

    #: Newest event time; transactions and the processing time (ms) until which each is known; open windows and their totals.
    STATE = "clock long, seen array<string>, until array<long>, starts array<long>, totals array<long>"

    def __init__(self, window: int, delay: int, remember_ms: int, quiet_ms: int, slow_ms: int) -> None:
        self.window, self.delay, self.slow_ms = window, delay, slow_ms
        self.remember_ms, self.quiet_ms = remember_ms, max(1, quiet_ms)

    def __call__(self, key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, width = state.getCurrentProcessingTimeMs(), len(_TOTALS)
        before, ids, until, starts, held = state.get if state.exists else (None, [], [], [], [])
        seen = {name: end for name, end in zip(ids, until) if end > now}
        windows = {start: list(held[i * width:(i + 1) * width]) for i, start in enumerate(starts)}
        newest, out = before, []
        if not state.hasTimedOut:
            for part in rows:
                for name, at, status, latency in zip(*(part[c].tolist() for c in ("transaction_id", "at", "http_status", "latency_ms"))):
                    at, status, latency = int(at), None if pd.isna(status) else int(status), None if pd.isna(latency) else int(latency)
                    if name in seen:
                        kind = "duplicate"
                    elif before is not None and at < before - self.delay:
                        kind = "late"
                    else:
                        kind = "event"
                        seen[name] = now + self.remember_ms
                        newest = at if newest is None else max(newest, at)
                        totals = windows.setdefault(at // self.window * self.window, [0] * width)
                        for i, counts in enumerate((True, status is not None, status == 401, status == 504 and latency is not None and latency > self.slow_ms)):
                            totals[i] += counts
                    out.append((kind, *key, name, at, status, latency, None, *[None] * width))
        # the windows that the key's time has passed, or all of them
        for start in [s for s in windows if state.hasTimedOut or newest is not None and s + self.window + self.delay <= newest]:
            out.append(("window", *key, None, None, None, None, start, *windows.pop(start)))
        state.update((newest, list(seen), list(seen.values()), list(windows), [n for totals in windows.values() for n in totals]))
        if not state.hasTimedOut:
            state.setTimeoutDuration(self.quiet_ms)
        elif seen:  # nothing is open: come back when the last transaction is forgotten
            state.setTimeoutDuration(max(1, max(seen.values()) - now))
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS, dtype=object)


def shard_of(transaction_id: str = "transaction_id") -> Column:
    return F.pmod(F.xxhash64(transaction_id), F.lit(SHARDS)).cast("int")


def ledger_rows(deliveries: DataFrame, window: str = "1 hour", delay: str = "10 minutes", remember: str = "7 days",
                quiet_seconds: int = 300, slow_ms: int = 5000, shard: Column | None = None) -> DataFrame:
    """The stream `deliveries` (transaction_id, merchant_id, timestamp, http_status, latency_ms) as ledger rows.

    Rows without transaction, merchant or timestamp cannot be placed and are left out. Times count in whole seconds. A
    repeated message is known as a duplicate for as long as `remember`.
    """
    rows = deliveries.select(
        F.col("merchant_id").cast("string"), (shard_of() if shard is None else shard).cast("int").alias("shard"), F.col("transaction_id").cast("string"),
        F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / 1_000_000).alias("at"), F.col("http_status").cast("int"), F.col("latency_ms").cast("int"))
    processor = LedgerProcessor(window_seconds(window), window_seconds(delay), 1000 * window_seconds(remember), 1000 * quiet_seconds, slow_ms)
    return (rows.filter("transaction_id is not null and merchant_id is not null and at is not null")
            .groupBy("merchant_id", "shard")
            .applyInPandasWithState(lambda key, parts, state: processor(key, parts, state), _ROW, processor.STATE, "append", GroupStateTimeout.ProcessingTimeTimeout))


def start_ledger(rows: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store ledger rows by kind, each batch in a folder of its own: a batch that is run again replaces what it stored.

    The query keeps its state in RocksDB, on disk beside the tasks; other queries of the session are not touched. With a
    trigger that ends (availableNow) timers go off in batches that have new files; without end also in empty ones.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/batch_id={batch_id}")

    own = {_PROVIDER: _ROCKS}
    if trigger.get("availableNow"):
        own[_EMPTY_BATCHES] = "false"  # as long as there are timers, there would be one more empty batch
    before = {name: spark.conf.get(name) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        return (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "10 seconds"})).foreachBatch(write).start())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All stored rows; none if nothing was ever stored."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _ROW)
    return spark.read.schema(_ROW).parquet(folder).drop("batch_id").select(*_COLUMNS)


def ledger_balance(ledger: DataFrame) -> DataFrame:
    """Per merchant: rows that came in, and as what they came out."""
    came = F.col("kind") != "window"
    return ledger.filter(came).groupBy("merchant_id").agg(
        F.count("*").alias("rows_in"), *[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("event", "duplicate", "late")])


def live_windows(ledger: DataFrame) -> DataFrame:
    """(merchant_id, window_start, txns, logs, unauthorized, overloaded): totals of the windows that came out."""
    return (ledger.filter("kind = 'window'").groupBy("merchant_id", F.timestamp_seconds("window_start").alias("window_start"))
            .agg(*[F.sum(t).alias(t) for t in _TOTALS]))


def live_auth_failures(windows: DataFrame, min_share: float = 1.0, at_least: int = 10) -> DataFrame:
    share = safe_divide("unauthorized", "logs")
    return windows.filter((F.col("logs") >= at_least) & (share >= min_share)).select(
        "merchant_id", "window_start", "logs", "unauthorized", share.alias("unauthorized_share"))


def live_overloads(windows: DataFrame, volume_factor: float = 2.0, min_overload_share: float = 0.5, at_least: int = 1) -> DataFrame:
    """Windows with volume above the mean of the merchant's windows so far, and timed-out, slow deliveries."""
    means = windows.groupBy("merchant_id").agg(F.avg("txns").alias("mean_txns"))
    share = safe_divide("overloaded", "logs")
    return windows.join(means, "merchant_id").filter(
        (F.col("txns") >= F.col("mean_txns") * volume_factor) & (F.col("overloaded") >= at_least) & (share >= min_overload_share)).select(
        "merchant_id", "window_start", "txns", "mean_txns", "overloaded", share.alias("overload_share"))
