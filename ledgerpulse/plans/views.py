"""The payment tables as views over the supplied parquet tables.

Transactions and delivery logs come from `events`, merchants from `customer`;
`orders` and `lineitem` give a second, larger pair with many logs per
transaction. Everything is a projection, so filters and column pruning reach
the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Category codes and card BINs of the payment tables.
MCC_CODES = ("5411", "5812", "5999", "7372", "5045", "4812", "5912", "7011", "5311", "5661")
CARD_BINS = ("400011", "411000", "424242", "512345", "601100", "371449", "378282", "601782", "411111")
DECLINE_CODES = (
    "93_Risk_Block", "51_Insufficient_Funds", "05_Do_Not_Honor", "14_Invalid_Card_Number",
    "54_Expired_Card", "57_Transaction_Not_Permitted", "91_Issuer_Switch_Inoperative",
)


def _pick(expression: str, values) -> str:
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {expression} {arms} end"


def _number_text(number: str) -> str:
    digits = f"cast({number} as string)"
    return f"lpad({digits}, greatest(8, length({digits})), '0')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HTTP_STATUS = (
    "case when user_id % 25 = 2 and event_id % 4 = 0 then 401 "
    "when user_id % 25 = 4 and event_id % 5 = 0 then 504 "
    "when event_id % 6 = 4 then 400 when event_id % 6 = 5 then 500 else 200 end"
)


def transaction_columns() -> list[str]:
    return [
        f"concat('TXN-', {_number_text('event_id')}) as transaction_id",
        "concat('merchant_id_', cast(user_id as string)) as merchant_id",
        "ts as timestamp",
        "value as amount",
        "'INR' as currency",
        "case when event_type = 'error' then 'DECLINED' else 'SUCCESS' end as status",
        "case when event_type <> 'error' then null else "
        + _pick("cast(regexp_extract(props, '([0-9]+)', 1) as int) % 7", DECLINE_CODES) + " end as decline_code",
        _pick("event_id % 9", CARD_BINS) + " as card_bin",
    ]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*transaction_columns())


def webhook_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per transaction, but none for every fiftieth, so left joins meet nulls."""
    events = table(spark, sf_dir, "events").where("event_id % 50 <> 7").selectExpr("*", f"{HTTP_STATUS} as http_status")
    return events.selectExpr(
        f"concat('WH-', {_number_text('event_id')}) as log_id",
        f"concat('TXN-', {_number_text('event_id')}) as transaction_id",
        "ts + make_dt_interval(0, 0, 0, 1 + event_id % 30) as timestamp",
        "case when event_type = 'error' then 'payment.failed' else 'payment.success' end as event_type",
        "http_status",
        "case when http_status = 200 then 1 else 1 + cast(event_id % 3 as int) end as delivery_attempts",
        "cast(case when http_status = 504 then 5001 + (event_id * 37) % 10000 "
        "else 50 + (event_id * 37) % 451 end as int) as latency_ms")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('merchant_id_', cast(c_custkey as string)) as merchant_id",
        "c_name as business_name",
        _pick("c_custkey % 10", MCC_CODES) + " as mcc_code",
        "concat('https://hooks.m', cast(c_custkey as string), '.example.com/payment/events') as webhook_url")


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions; failed orders carry a decline code."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as transaction_id",
        "concat('merchant_id_', cast(o_custkey as string)) as merchant_id",
        "o_orderdate as timestamp",
        "o_totalprice as amount",
        "case when o_orderstatus = 'P' then 'DECLINED' else 'SUCCESS' end as status",
        "case when o_orderstatus <> 'P' then null else " + _pick("o_orderkey % 7", DECLINE_CODES) + " end as decline_code")


def line_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as delivery logs, several per order."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as transaction_id",
        "concat(cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string)) as log_id",
        "l_shipdate as timestamp",
        "cast(case when l_returnflag = 'R' then 500 when l_linestatus = 'F' and l_partkey % 8 = 0 then 401 "
        "else 200 end as int) as http_status",
        "cast(1 + l_linenumber % 3 as int) as delivery_attempts")


def live_event_columns() -> list[str]:
    """Events as the fields of a live message, timestamps as ISO text."""
    return [
        *[c for c in transaction_columns() if not c.endswith((" as timestamp", " as card_bin"))],
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as timestamp",
        f"case when event_id % 50 = 7 then null else {HTTP_STATUS} end as webhook_http_status",
        "case when event_type = 'error' then 'payment.failed' else 'payment.success' end as event_type",
        "cast(null as string) as anomaly_type",
    ]


def delivery_columns() -> list[str]:
    """Events as live deliveries: a transaction with the outcome of its delivery, none for every fiftieth."""
    return [
        "event_id as number", *[c for c in transaction_columns() if c.endswith((" as transaction_id", " as merchant_id", " as timestamp"))],
        f"case when event_id % 50 <> 7 then {HTTP_STATUS} end as http_status",
        f"case when event_id % 50 = 7 then null when ({HTTP_STATUS}) = 504 then 5001 + (event_id * 37) % 10000 else 50 + (event_id * 37) % 451 end as latency_ms",
    ]


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*live_event_columns())


def ingest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw payload text; some lack a field, some are no JSON, some have no amount."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case when event_id % 41 = 1 then concat('{\"transaction_id\":\"TXN-', cast(event_id as string)) else "
        "concat('{\"transaction_id\":\"TXN-', cast(event_id as string), "
        "'\",\"merchant_id\":\"merchant_id_', cast(user_id as string), '\",\"amount\":', "
        "cast(case when event_id % 37 = 2 then 0.0 else value end as string), "
        "case when event_id % 29 = 3 then '' when event_type = 'error' "
        "then ',\"status\":\"FAILED\",\"error_code\":\"INSUFFICIENT_FUNDS\"' else ',\"status\":\"SUCCESS\"' end, "
        "case when event_id % 5 = 0 then ',\"currency\":\"USD\"' else '' end, '}') end as value")


TRANSCRIPT_SUFFIX = (
    # (remainder of (conv_id + turn) % 8, text added to the reply)
    (1, " The payment was declined with a decline code of '93_Risk_Block'. I'll check our knowledge base."),
    (2, " I will look up the definition in our documentation."),
    (3, "\n{\"name\": \"search_knowledge_base\", \"parameters\": {\"query\": \"code 51\"}}\n\n\nDone."),
    (4, "\n{\"name\": \"some_other_thing\", \"value\": 42}"),
    (5, " Your card was refused: error_code: 51_Insufficient_Funds. Let me consult the tool."),
    (6, " {\"name\":\"retry_failed_webhook\",\"parameters\":{\"log_id\":\"WH-00000007\"}} ok"),
    (7, " Declined with decline code of '14_Invalid_Card_Number'.\n{\"name\": \"search_knowledge_base\", \"parameters\": {\"query\": \"code 14\"}}"),
)


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose replies end in typical agent phrases."""
    def quoted(text):
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"
    arms = " ".join(f"when {n} then {quoted(t)}" for n, t in TRANSCRIPT_SUFFIX)
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "role",
        f"concat(text, case (conv_id + turn) % 8 {arms} else '' end) as text")
