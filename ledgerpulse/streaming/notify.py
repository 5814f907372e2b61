"""Notice of newly arrived alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerpulse.sources.alert_table import alert_arrivals


def start_notifications(spark: SparkSession, alert_path: str, checkpoint: str,
                        notify: Callable[[int], None], **trigger) -> StreamingQuery:
    """Call `notify(number of new alerts)` for every batch that brought some.

    The checkpoint remembers the files already seen, so alerts are announced
    once, also after a restart.
    """
    def announce(batch: DataFrame, _batch_id: int) -> None:
        arrived = batch.count()
        if arrived:
            notify(arrived)

    return (alert_arrivals(spark, alert_path).writeStream
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "3 seconds"}))
            .foreachBatch(announce).start())
