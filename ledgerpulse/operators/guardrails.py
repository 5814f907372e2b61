"""Batch audit and repair of agent replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions import transcripts as tx
from ledgerpulse.functions.expressions import decline_code_number
from ledgerpulse.functions.knowledge import decline_knowledge


def flag_replies(replies: DataFrame) -> DataFrame:
    return replies.withColumns({
        "is_incomplete": tx.is_incomplete("text"),
        "has_tool_call": tx.has_tool_call("text"),
        "has_raw_json": tx.has_raw_json("text"),
        "decline_code": tx.decline_code_in("text")})


def clean_replies(replies: DataFrame) -> DataFrame:
    """Adds `clean_text` without leaked tool calls."""
    return replies.withColumn("clean_text", tx.strip_tool_calls("text"))


def audit(replies: DataFrame, *by: str) -> DataFrame:
    """Number of flagged replies per group."""
    flags = flag_replies(replies)
    return flags.groupBy(*by).agg(
        F.count("*").alias("replies"),
        F.count_if("is_incomplete").alias("incomplete"),
        F.count_if("has_tool_call").alias("tool_call_leaks"),
        F.count_if("has_raw_json").alias("raw_json"))


def repair(replies: DataFrame) -> DataFrame:
    """Complete unfinished replies from the decline-code documents.

    Leaked tool calls are noted on the raw reply and cut first; everything else looks at the cut reply. A
    reply that broke off or leaked and names a known code gets the document of the code appended; one
    without a known code is marked NEEDS_RETRY. All others are OK. No output holds a leaked call.
    """
    knowledge = F.broadcast(decline_knowledge(replies.sparkSession))  # seven rows
    cleaned = clean_replies(replies.withColumn("_leaked", tx.has_tool_call("text")))
    flags = cleaned.withColumns({
        "_needs": tx.is_incomplete("clean_text") | F.col("_leaked"), "_code": tx.decline_code_in("clean_text")})
    joined = flags.join(knowledge, decline_code_number("_code") == F.col("code"), "left")
    document = F.concat_ws("\n\n", F.concat(F.lit("Meaning: "), F.col("meaning")), F.concat(F.lit("When to Expect It: "), F.col("expect")),
                           F.concat(F.lit("Merchant Action: "), F.col("action")))
    repaired = F.concat(
        tx.without_promise("clean_text"), F.lit(".\n\nAccording to our knowledge base, decline code **"),
        F.col("_code"), F.lit("** means the following:\n\n"), document)
    known = F.col("code").isNotNull()
    return joined.select(
        *replies.columns,
        F.when(~F.col("_needs"), F.lit("OK")).when(known, F.lit("REPAIRED")).otherwise(F.lit("NEEDS_RETRY")).alias("repair_status"),
        F.when(F.col("_needs") & known, repaired).otherwise(F.col("clean_text")).alias("repaired_text"))
