"""Per-event scoring of live messages. The same steps run on a stream or a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerpulse.functions.expressions import live_feature_map, parsed_event_time
from ledgerpulse.operators.iforest import IsolationForestModel
from ledgerpulse.schemas import LIVE_FEATURES
from ledgerpulse.sources.alert_table import append_batch_once, live_alert, writer_of
from ledgerpulse.sources.messages import parse_live_events

def with_live_features(events: DataFrame) -> DataFrame:
    """Adds the model features and whether the event time could not be read."""
    features = live_feature_map()
    return events.withColumns({
        "bad_timestamp": parsed_event_time("timestamp").isNull(),
        **{name: features[name] for name in LIVE_FEATURES}})


def score_events(messages: DataFrame, model: IsolationForestModel, as_expression: bool = False) -> DataFrame:
    """Messages with features, decision and prediction; nothing is filtered yet.

    `as_expression` scores a small forest as one generated expression instead of in Python workers;
    the results are the same.
    """
    prepared = with_live_features(parse_live_events(messages))
    return model.with_labels(model.with_expression_score(prepared) if as_expression else model.with_score(prepared))


def live_alerts(messages: DataFrame, model: IsolationForestModel, as_expression: bool = False) -> DataFrame:
    """Alert rows of the anomalous events; normal events are dropped."""
    return live_alert(score_events(messages, model, as_expression))


def start_scoring(messages: DataFrame, model: IsolationForestModel, alert_path: str, checkpoint: str,
                  as_expression: bool = False, **trigger) -> StreamingQuery:
    """Score a message stream and append its anomalies to the alert table, each once."""
    return (live_alerts(messages, model, as_expression).writeStream
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .foreachBatch(append_batch_once(alert_path, writer_of("events", checkpoint)))
            .start())
