"""Event messages: topic source and sink, validated ingest."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.schemas import INGEST_EVENT, LIVE_EVENT

TOPIC = "live_transactions"
CONSUMER_GROUP = "ml-watcher-group"


def bootstrap_servers() -> str:
    return os.getenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")


def raw_messages(spark: SparkSession, source_kind: str = "kafka", path: str | None = None,
                 starting: str = "latest", max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded table with one string column `value`.

    `kafka` reads the topic from the latest offset; the query's checkpoint
    keeps the position, in place of committed offsets. `files` reads JSON
    lines that arrive in a folder. Kafka needs its connector on the class path.
    """
    if source_kind == "kafka":
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers())
                .option("subscribe", TOPIC)
                .option("groupIdPrefix", CONSUMER_GROUP)
                .option("startingOffsets", starting)
                .load().select(F.col("value").cast("string").alias("value")))
    if source_kind == "files":
        if not path:
            raise ValueError("source_kind 'files' needs a path")
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.text(path)
    raise ValueError(f"unknown source kind '{source_kind}'")


def _parsed(schema) -> Column:
    """The text as struct `event`.

    Exploding a one-element array keeps the parse in its own step: later
    filters read its fields instead of parsing the text once per field.
    """
    return F.explode(F.array(F.from_json("value", schema))).alias("event")


def parse_live_events(messages: DataFrame) -> DataFrame:
    """JSON text to event columns; text that is no JSON gives null fields."""
    return messages.select("value", _parsed(LIVE_EVENT)).select("value", "event.*")


def as_messages(df: DataFrame) -> DataFrame:
    """Every row as JSON text in `value`; null fields are kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish(df: DataFrame, sink_kind: str = "kafka", path: str | None = None) -> None:
    """Send rows as JSON. `files` appends JSON lines to a folder."""
    messages = as_messages(df)
    if sink_kind == "kafka":
        (messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers())
         .option("topic", TOPIC).option("kafka.acks", "all").option("kafka.retries", "5").save())
    elif sink_kind == "files":
        if not path:
            raise ValueError("sink_kind 'files' needs a path")
        messages.write.mode("append").text(path)
    else:
        raise ValueError(f"unknown sink kind '{sink_kind}'")


# ---- validated ingest ------------------------------------------------------

def parse_ingest(messages: DataFrame) -> DataFrame:
    """Payload text to columns plus `problem`, null for a valid event."""
    parsed = messages.select("*", _parsed(INGEST_EVENT))
    event = lambda name: F.col(f"event.{name}")
    readable = F.coalesce(F.json_object_keys("value").isNotNull(), F.lit(False))
    problem = (F.when(~readable, F.lit("not a JSON object"))
               .when(event("transaction_id").isNull(), F.lit("transaction_id missing"))
               .when(event("merchant_id").isNull(), F.lit("merchant_id missing"))
               .when(event("amount").isNull(), F.lit("amount missing"))
               .when(~(event("amount") > 0), F.lit("amount must be greater than 0"))
               .when(event("status").isNull(), F.lit("status missing")))
    return parsed.withColumn("problem", problem)


def accepted(parsed: DataFrame) -> DataFrame:
    """Valid events, currency INR unless given, with their acknowledgement."""
    return (parsed.filter(F.col("problem").isNull()).select("event.*")
            .withColumn("currency", F.coalesce("currency", F.lit("INR")))
            .withColumn("received", F.lit(True))
            .withColumn("message", acknowledgement(F.col("transaction_id"))))


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).drop("event")


def acknowledgement(transaction_id: Column) -> Column:
    return F.concat(F.lit("Payment event for transaction "), transaction_id, F.lit(" acknowledged."))
