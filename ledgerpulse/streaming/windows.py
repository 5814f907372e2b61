"""Windowed features and alerts on an unbounded transaction table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerpulse.operators.alerts import window_alerts
from ledgerpulse.operators.features import DEFAULT_WINDOW, finish_features, window_aggregates
from ledgerpulse.operators.iforest import IsolationForestModel
from ledgerpulse.operators.lookups import with_defaults
from ledgerpulse.sources.alert_table import append_batch_once, writer_of


def streaming_features(transactions: DataFrame, window: str = DEFAULT_WINDOW, delay: str = "10 minutes") -> DataFrame:
    """Feature rows of closed windows; rows later than `delay` are left out.

    State holds one partial aggregate per open (merchant, window), not rows.
    """
    source = with_defaults(transactions, {"decline_code": ""})
    timed = (source.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
             .withWatermark("timestamp", delay)
             # a condition on the time as well: the optimiser would move one on merchant_id alone ahead of the watermark
             .filter(F.when(F.col("merchant_id").isNotNull(), F.col("timestamp")).isNotNull()))
    return finish_features(timed.groupBy("merchant_id", F.window("timestamp", window)).agg(*window_aggregates()))


#: Waits for the whole of a bounded input, in whatever order its files come.
WHOLE_INPUT = "36500 days"


class BoundedInput:
    """A stream that ends: `stream` is the source and a folder for the mark of its end.

    Run the query to the end of the source, call `close`, and run it again with the same checkpoint:
    the mark moves the watermark beyond every window, so all that are still open are emitted.
    """

    def __init__(self, source: DataFrame, folder: str) -> None:
        self.spark, self.folder = source.sparkSession, folder
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in source.schema])
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(folder)
        self.stream = source.unionByName(self.spark.readStream.schema(self.schema).parquet(folder))

    def close(self) -> None:
        last = [F.lit("9999-12-31").cast(f.dataType).alias(f.name) if f.name == "timestamp" else F.lit(None).cast(f.dataType).alias(f.name)
                for f in self.schema]
        self.spark.range(1).select(*last).write.mode("append").parquet(self.folder)

    def drain(self, start: Callable[[DataFrame], StreamingQuery]) -> None:
        """Runs the query that `start` starts on the stream, over the source and then over the mark."""
        start(self.stream).awaitTermination()
        self.close()
        start(self.stream).awaitTermination()


def late_rows(query: StreamingQuery) -> int:
    """Partial aggregates that came behind the watermark and were left out, over the batches the query still knows."""
    return sum(state.numRowsDroppedByWatermark for p in query.recentProgress for state in p.stateOperators)


def start_window_alerts(features: DataFrame, model: IsolationForestModel, alert_path: str, checkpoint: str,
                        **trigger) -> StreamingQuery:
    """Score closed windows with a fitted model and append the anomalous ones."""
    return (window_alerts(model.transform(features)).writeStream
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .foreachBatch(append_batch_once(alert_path, writer_of("windows", checkpoint)))
            .start())


def store_stream(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream's rows to a parquet folder with exactly-once file commits."""
    return (df.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
