"""Plain SQL for each named query, in DuckDB's dialect, on the same parquet tables."""

from __future__ import annotations

from ledgerpulse.functions.knowledge import DECLINE_CODES, WEBHOOK_STATUSES

_ID = "lpad(cast({n} as varchar), cast(greatest(8, length(cast({n} as varchar))) as int), '0')"
_EVENT_ID = _ID.format(n="event_id")
_CODES = """case {n} when 0 then '93_Risk_Block' when 1 then '51_Insufficient_Funds' when 2 then '05_Do_Not_Honor'
 when 3 then '14_Invalid_Card_Number' when 4 then '54_Expired_Card' when 5 then '57_Transaction_Not_Permitted'
 else '91_Issuer_Switch_Inoperative' end"""
_HTTP = """case when user_id % 25 = 2 and event_id % 4 = 0 then 401 when user_id % 25 = 4 and event_id % 5 = 0 then 504
 when event_id % 6 = 4 then 400 when event_id % 6 = 5 then 500 else 200 end"""
_EVENT_CODE = _CODES.format(n="cast(regexp_extract(props, '([0-9]+)', 1) as int) % 7")
_ORDER_CODE = _CODES.format(n="o_orderkey % 7")



def _row(values) -> str:
    """Documented knowledge as a row of SQL literals."""
    return "(" + ", ".join("null" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in values) + ")"


_TABLES = {
    "t": f"""select 'TXN-' || {_EVENT_ID} as transaction_id, 'merchant_id_' || user_id as merchant_id,
 ts as "timestamp", value as amount, 'INR' as currency,
 case when event_type = 'error' then 'DECLINED' else 'SUCCESS' end as status,
 case when event_type = 'error' then {_EVENT_CODE} end as decline_code,
 case event_id % 9 when 0 then '400011' when 1 then '411000' when 2 then '424242' when 3 then '512345'
 when 4 then '601100' when 5 then '371449' when 6 then '378282' when 7 then '601782' else '411111' end as card_bin
 from events""",
    "l": f"""select 'WH-' || {_EVENT_ID} as log_id, 'TXN-' || {_EVENT_ID} as transaction_id,
 ts + to_seconds(1 + event_id % 30) as "timestamp",
 case when event_type = 'error' then 'payment.failed' else 'payment.success' end as event_type, http_status,
 case when http_status = 200 then 1 else 1 + cast(event_id % 3 as int) end as delivery_attempts,
 cast(case when http_status = 504 then 5001 + (event_id * 37) % 10000 else 50 + (event_id * 37) % 451 end as int) as latency_ms
 from (select *, {_HTTP} as http_status from events where event_id % 50 <> 7)""",
    "m": """select 'merchant_id_' || c_custkey as merchant_id, c_name as business_name,
 case c_custkey % 10 when 0 then '5411' when 1 then '5812' when 2 then '5999' when 3 then '7372' when 4 then '5045'
 when 5 then '4812' when 6 then '5912' when 7 then '7011' when 8 then '5311' else '5661' end as mcc_code,
 'https://hooks.m' || c_custkey || '.example.com/payment/events' as webhook_url from customer""",
    "j": """select t.*, l.log_id, l."timestamp" as timestamp_wh, l.event_type, l.http_status, l.delivery_attempts, l.latency_ms
 from t left join l using (transaction_id)""",
    "lm": "select l.*, t.merchant_id from l join t using (transaction_id)",
    "ot": f"""select o_orderkey as transaction_id, 'merchant_id_' || o_custkey as merchant_id, o_orderdate as "timestamp",
 o_totalprice as amount, case when o_orderstatus = 'P' then 'DECLINED' else 'SUCCESS' end as status,
 case when o_orderstatus = 'P' then {_ORDER_CODE} end as decline_code from orders""",
    "ll": """select l_orderkey as transaction_id, l_linenumber || '-' || l_partkey || '-' || l_suppkey as log_id,
 l_shipdate as "timestamp",
 case when l_returnflag = 'R' then 500 when l_linestatus = 'F' and l_partkey % 8 = 0 then 401 else 200 end as http_status,
 cast(1 + l_linenumber % 3 as int) as delivery_attempts from lineitem""",
    "fd": """select merchant_id, time_bucket(interval '1 day', "timestamp") as "timestamp", count(transaction_id) as total_transactions,
 count(*) filter (status = 'DECLINED') as decline_count,
 count(*) filter (status = 'DECLINED') / count(transaction_id)::double as decline_ratio, avg(amount) as avg_amount,
 count(*) filter (decline_code = '93_Risk_Block') as risk_block_count from t group by 1, 2""",
    "al": """select merchant_id, "timestamp" as window_start,
 case when risk_block_count > 10 then 'High Risk Block Spike' when decline_ratio > 0.6 then 'Elevated Decline Ratio'
 else 'General Transaction Anomaly' end as alert_type, description,
 cast(printf('%.4f', decline_ratio) as double) as decline_ratio, total_transactions
 from (select *, case
 when decline_ratio > 0.8 then 'High volume of failed transactions detected: ' || decline_count || '/' || total_transactions
 || ' declined (ratio: ' || printf('%.2f', decline_ratio * 100.0) || '%, avg amount: $' || printf('%.2f', round(avg_amount, 9)) || ')'
 when decline_ratio > 0.5 then 'Elevated decline rate: ' || decline_count || '/' || total_transactions
 || ' declined (ratio: ' || printf('%.2f', decline_ratio * 100.0) || '%)'
 else 'Anomalous transaction pattern detected: ' || total_transactions || ' transactions, ' || decline_count
 || ' declined, avg amount $' || printf('%.2f', round(avg_amount, 9)) end as description from fd)""",
    "up": "select distinct 'WH' || substr(transaction_id, 4) as log_id from t where status = 'DECLINED'",
    "kb": "select * from (values " + ", ".join(_row(r) for r in DECLINE_CODES) + ") v(code, title, meaning, expect, action)",
    "ws": "select * from (values " + ", ".join(_row(r) for r in WEBHOOK_STATUSES) + ") v(http_status, status_meaning, gateway_action)",
    "rt": """select *, row_number() over (partition by merchant_id order by "timestamp" desc, transaction_id)::int as rank from t""",
    "rl": """select *, row_number() over (partition by merchant_id order by "timestamp" desc, log_id)::int as rank from lm""",
    "pr": """select transaction_id, status, cast(coalesce(decline_code = '93_Risk_Block', false) or coalesce(http_status = 401, false) as int) as y_true,
 case when status = 'DECLINED' or coalesce(http_status >= 401, false) then 1 else 0 end as y_pred from j""",
    "cc": """select lang as model, count(*) filter (quality = 0 and toxic = 1) as tp, count(*) filter (quality = 0 and toxic = 0) as fp,
 count(*) filter (quality = 1 and toxic = 1) as fn, count(*) filter (quality = 1 and toxic = 0) as tn
 from labels join documents using (doc_id) group by 1""",
    "sc": """select *, case when tp + fp > 0 then tp / (tp + fp)::double else 0.0 end as precision,
 case when tp + fn > 0 then tp / (tp + fn)::double else 0.0 end as recall,
 case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0.0 end as f1 from cc""",
    "lf": """select transaction_id, coalesce(amount, 0.0) as amount, coalesce(http_status, 0)::double as http_status,
 coalesce(delivery_attempts, 0)::double as delivery_attempts,
 cast(coalesce(decline_code = '93_Risk_Block', false) or coalesce(http_status = 401, false) as int) as y_true from j""",
    "lv": f"""select 'TXN-' || {_EVENT_ID} as transaction_id, 'merchant_id_' || user_id as merchant_id, value as amount,
 case when event_type = 'error' then 1.0 else 0.0 end as is_declined,
 case when event_type = 'error' and cast(regexp_extract(props, '([0-9]+)', 1) as int) % 7 = 0 then 1.0 else 0.0 end as is_risk_block,
 case when http = 401 then 1.0 else 0.0 end as is_webhook_401, case when http >= 400 then 1.0 else 0.0 end as is_webhook_error,
 hour(ts)::double as hour_of_day
 from (select *, case when event_id % 50 = 7 then 200 else {_HTTP} end as http from events)""",
    "fs": """select *, pow(2.0, -h / c256) as s from (
 select *, 2 * (ln(255) + 0.5772156649015329) - 2 * 255 / 256.0::double as c256, (
 case when is_webhook_401 <= 0.5 then case when is_risk_block <= 0.5 then 2 + 2 * (ln(227) + 0.5772156649015329) - 2 * 227 / 228.0::double
 else 2 + 2 * (ln(11) + 0.5772156649015329) - 2 * 11 / 12.0::double end
 else 1 + 2 * (ln(15) + 0.5772156649015329) - 2 * 15 / 16.0::double end
 + case when amount <= 150 then case when is_webhook_error <= 0.5 then 2 + 2 * (ln(189) + 0.5772156649015329) - 2 * 189 / 190.0::double
 else 2 + 2 * (ln(45) + 0.5772156649015329) - 2 * 45 / 46.0::double end
 else case when is_declined <= 0.5 then 2 + 2 * (ln(14) + 0.5772156649015329) - 2 * 14 / 15.0::double
 else 2 + 2 * (ln(4) + 0.5772156649015329) - 2 * 4 / 5.0::double end end
 + case when is_risk_block <= 0.5 then case when hour_of_day <= 3.5 then 2 + 2 * (ln(39) + 0.5772156649015329) - 2 * 39 / 40.0::double
 else 2 + 2 * (ln(203) + 0.5772156649015329) - 2 * 203 / 204.0::double end
 else 1 + 2 * (ln(11) + 0.5772156649015329) - 2 * 11 / 12.0::double end) / 3.0::double as h from lv)""",
    "pay": """select event_id, case when event_id % 41 = 1 then '{"transaction_id":"TXN-' || event_id else
 '{"transaction_id":"TXN-' || event_id || '","merchant_id":"merchant_id_' || user_id || '","amount":'
 || cast(case when event_id % 37 = 2 then 0.0 else value end as varchar)
 || case when event_id % 29 = 3 then '' when event_type = 'error' then ',"status":"FAILED","error_code":"INSUFFICIENT_FUNDS"'
 else ',"status":"SUCCESS"' end || case when event_id % 5 = 0 then ',"currency":"USD"' else '' end || '}' end as value from events""",
    "ing": """select event_id, case when not json_valid(value) then 'not a JSON object'
 when try_cast(doc ->> 'amount' as double) is null then 'amount missing'
 when not cast(doc ->> 'amount' as double) > 0 then 'amount must be greater than 0'
 when doc ->> 'status' is null then 'status missing' end as problem,
 doc ->> 'transaction_id' as transaction_id, doc ->> 'merchant_id' as merchant_id, cast(doc ->> 'amount' as double) as amount,
 coalesce(doc ->> 'currency', 'INR') as currency, doc ->> 'status' as status, doc ->> 'error_code' as error_code
 from (select *, case when json_valid(value) then cast(value as json) end as doc from pay)""",
    "tr": """select conv_id, turn, role, text || case (conv_id + turn) % 8
 when 1 then ' The payment was declined with a decline code of ''93_Risk_Block''. I''ll check our knowledge base.'
 when 2 then ' I will look up the definition in our documentation.'
 when 3 then chr(10) || '{"name": "search_knowledge_base", "parameters": {"query": "code 51"}}' || chr(10) || chr(10) || chr(10) || 'Done.'
 when 4 then chr(10) || '{"name": "some_other_thing", "value": 42}'
 when 5 then ' Your card was refused: error_code: 51_Insufficient_Funds. Let me consult the tool.'
 when 6 then ' {"name":"retry_failed_webhook","parameters":{"log_id":"WH-00000007"}} ok'
 when 7 then ' Declined with decline code of ''14_Invalid_Card_Number''.' || chr(10) || '{"name": "search_knowledge_base", "parameters": {"query": "code 14"}}'
 else '' end as text from conversations""",
    "tf": r"""select *, regexp_matches(text, '(?i)(?:I''?ll|I will|I am going to|I''m going to|let me|I need to)\s+(?:check|search|look\s*(?:up|into)|query|consult|retrieve|access|investigate|find)[^.!?]{0,80}?\s*(?:knowledge\s*base|KB|database|documentation|tool|system)') as is_incomplete,
 contains(text, '"name": "fetch_transaction_logs"') or contains(text, '"name":"fetch_transaction_logs"')
 or contains(text, '"name": "retry_failed_webhook"') or contains(text, '"name":"retry_failed_webhook"')
 or contains(text, '"name": "search_knowledge_base"') or contains(text, '"name":"search_knowledge_base"')
 or contains(text, '"name": "fetch_merchant_diagnostics"') or contains(text, '"name":"fetch_merchant_diagnostics"')
 or contains(text, '"name": "check_ml_system_alerts"') or contains(text, '"name":"check_ml_system_alerts"') as has_tool_call,
 text like '{%' or contains(text, chr(10) || '{') as has_raw_json,
 nullif(regexp_extract(text, '(?i)(?:decline[_ ]code|error[_ ]code|code)(?:\s*[:,]\s*|\s+(?:of|is|was)\s+|\s+)["'']?(\d{1,3}[_A-Za-z]\w*)["'']?', 1), '') as decline_code
 from tr""",
    "tp": """select label as query_id, list(x order by place) as v from (
 select label, place, avg(embedding[place]::double) as x from embeddings, range(1, 65) r(place) group by 1, 2) group by 1""",
    "hit": """select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from (
 select query_id, vec_id, list_inner_product(v, embedding::double[]) as score from tp, embeddings)""",
}

_TABLES |= {
    "dl": f"""select event_id, 'merchant_id_' || user_id as merchant_id, cast(floor(epoch(ts)) as bigint) as moment, event_id % 4 as shard,
 case when event_id % 50 <> 7 then {_HTTP} end as http_status,
 case when event_id % 50 = 7 then null when ({_HTTP}) = 504 then 5001 + (event_id * 37) % 10000 else 50 + (event_id * 37) % 451 end as latency_ms from events""",
    "ck": "select merchant_id, shard, max(moment) as clock from dl where event_id % 20 <> 7 group by 1, 2",
    "dk": """select dl.*, case when event_id % 20 = 7 and coalesce(moment < clock - 86400, false) then 'late' else 'event' end as kind from dl left join ck using (merchant_id, shard)
 union all select *, 'duplicate' from dl where event_id % 10 = 3""",
    "lw": """select merchant_id, make_timestamp(moment // 86400 * 86400 * 1000000) as window_start, count(*) as txns, count(http_status) as logs,
 count(*) filter (http_status = 401) as unauthorized, count(*) filter (http_status = 504 and latency_ms > 5000) as overloaded from dk where kind = 'event' group by 1, 2""",
}

_NEEDS = {
    "ck": ["dl"], "dk": ["dl", "ck"], "lw": ["dl", "ck", "dk"],
    "j": ["t", "l"], "lm": ["t", "l"], "fd": ["t"], "al": ["t", "fd"], "up": ["t"], "rt": ["t"], "rl": ["t", "l", "lm"],
    "pr": ["t", "l", "j"], "sc": ["cc"], "lf": ["t", "l", "j"], "fs": ["lv"], "ing": ["pay"], "tf": ["tr"], "hit": ["tp"],
}


def _sql(tables: str, body: str) -> str:
    wanted: list[str] = []
    for name in tables.split():
        for part in [*_NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    if not wanted:
        return body
    return "with " + ", ".join(f"{n} as ({_TABLES[n]})" for n in wanted) + ("" if body.startswith(",") else " ") + body


_BUCKETS = """select {key}, cast('0x' || substr(md5(term), 1, 8) as bigint) % 1048576 as bucket, count(*) as tf
 from (select {key}, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as term from {table}) group by all"""
#: Unit term weights of the lines of the documents (p) and of the benchmark items (q).
_KB_LINES = f"""with cut as (select doc_id, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line from documents),
 lines as (select doc_id || '-' || line as vec_id, text from cut where regexp_matches(text, '[\\p{{L}}\\p{{N}}]')),
 pc as ({_BUCKETS.format(key="vec_id", table="lines")}), qc as ({_BUCKETS.format(key="query_id", table="(select item_id as query_id, text from benchmark)")}),
 df as (select bucket, count(*) as df from pc group by 1),
 pr as (select vec_id, bucket, tf * ln(((select count(*) from lines) + 1.0) / (df + 1)) as raw from pc join df using (bucket)),
 qr as (select query_id, bucket, tf * ln(((select count(*) from lines) + 1.0) / (coalesce(df, 0) + 1)) as raw from qc left join df using (bucket)),
 p as (select vec_id, bucket, raw / sqrt(sum(raw * raw) over (partition by vec_id)) as weight from pr where raw > 0),
 q as (select query_id, bucket, raw / sqrt(sum(raw * raw) over (partition by query_id)) as weight from qr where raw > 0)"""


def _bursts(rows: str, key: str, sums: dict[str, str], window: int, condition: str, peaks: list[str]) -> str:
    """Totals over the window that ends at each second with events, and overlapping windows that meet the condition as one row."""
    totals = ", ".join(f"sum({name}) over (partition by {key} order by moment range between {window - 1} preceding and current row) as {name}" for name in sums)
    return f""", ev as ({rows}), sec as (select {key}, cast(floor(epoch("timestamp")) as bigint) as moment,
 {", ".join(f"sum({value}) as {name}" for name, value in sums.items())} from ev where {key} is not null group by 1, 2),
 tot as (select {key}, moment, {totals} from sec),
 hit as (select *, case when moment - lag(moment) over (partition by {key} order by moment) <= {window} then 0 else 1 end as fresh from tot where {condition}),
 num as (select *, sum(fresh) over (partition by {key} order by moment) as burst from hit)
 select {key}, make_timestamp((min(moment) - {window - 1}) * 1000000) as burst_start, make_timestamp(max(moment) * 1000000) as burst_end, count(*) as windows,
 {", ".join(f"max({p}) as peak_{p}" for p in peaks)} from num group by {key}, burst"""


def _pct(n: str, d: str) -> str:
    return f"case when {d} = 0 then 0.0 else cast(printf('%.1f', {n} / {d}::double * 100.0) as double) end"


_FAILED = "(status <> 'SUCCESS' or coalesce(not (http_status between 200 and 299), false))"
_FEATURES = """merchant_id, "timestamp", total_transactions, decline_count, round(decline_ratio, 6) as decline_ratio,
 round(avg_amount, 6) as avg_amount, risk_block_count"""


def _window(source: str, size: str, digits: int) -> str:
    return f"""select merchant_id, time_bucket(interval '{size}', "timestamp") as "timestamp", count(*) as total_transactions,
 count(*) filter (status = 'DECLINED') as decline_count,
 round(count(*) filter (status = 'DECLINED') / count(*)::double, {digits}) as decline_ratio, round(avg(amount), {digits}) as avg_amount,
 count(*) filter (decline_code = '93_Risk_Block') as risk_block_count from {source} group by 1, 2"""


def _summary(source: str) -> str:
    return f"""select count(*) as row_count, round(avg((status = 'SUCCESS')::int::double), 6) as success_share,
 round(avg((status = 'DECLINED')::int::double), 6) as declined_share, min(amount) as min_amount, max(amount) as max_amount,
 round(quantile_cont(amount, 0.5), 6) as median_amount from {source}"""


_AUDIT = """count(*) as replies, count(*) filter (is_incomplete) as incomplete, count(*) filter (has_tool_call) as tool_call_leaks,
 count(*) filter (has_raw_json) as raw_json from tf group by 1"""

_REPORT = """, c as (select merchant_id, string_agg('  • ' || decline_code || ': ' || n || ' occurrences', chr(10) order by n desc, seen) as code_lines
 from (select merchant_id, decline_code, count(*) as n, min(rank) as seen from rt where rank <= 50 and decline_code is not null group by 1, 2) group by 1),
 h as (select merchant_id, string_agg('  • HTTP ' || http_status || ': ' || n || ' deliveries', chr(10) order by n desc, seen) as status_lines
 from (select merchant_id, http_status, count(*) as n, min(rank) as seen from rl where rank <= 50 group by 1, 2) group by 1),
 s as (select merchant_id, string_agg('  • log_id=' || log_id || '  http_status=' || http_status || '  event_type=' || event_type, chr(10) order by rank) as recent_lines
 from rl where rank <= 5 group by 1),
 a as (select merchant_id, count(*) as total, count(*) filter (status = 'SUCCESS') as success_count from rt where rank <= 50 group by 1),
 b as (select merchant_id, count(*) as log_total from rl where rank <= 50 group by 1)
 select merchant_id, coalesce(total, 0) as total, coalesce(success_count, 0) as success_count,
 coalesce(total - success_count, 0) as non_success_count, coalesce(log_total, 0) as log_total,
 'Diagnostic report for ' || merchant_id || ' (last ' || coalesce(total, 0) || ' transactions, last ' || coalesce(log_total, 0)
 || ' webhook logs):' || chr(10) || chr(10) || 'Transaction breakdown: ' || coalesce(success_count, 0) || ' SUCCESS, '
 || coalesce(total - success_count, 0) || ' DECLINED.' || chr(10)
 || coalesce('Decline code frequency:' || chr(10) || code_lines, 'No decline codes recorded in this window.') || chr(10) || chr(10)
 || 'Webhook HTTP status frequency:' || chr(10) || coalesce(status_lines, '  (no webhook logs found)') || chr(10) || chr(10)
 || 'Most-recent webhook log entries (for retry reference):' || chr(10) || coalesce(recent_lines, '  (none)') as report
 from m left join a using (merchant_id) left join b using (merchant_id) left join c using (merchant_id)
 left join h using (merchant_id) left join s using (merchant_id)"""

_CHECKS = {
    "duplicate_merchant_id": "select count(*) - count(distinct merchant_id) from m",
    "duplicate_transaction_id": "select count(*) - count(distinct transaction_id) from t",
    "duplicate_log_id": "select count(*) - count(distinct log_id) from l",
    "status_domain": "select count(*) from t where status not in ('SUCCESS', 'DECLINED')",
    "currency_domain": "select count(*) from t where currency <> 'INR'",
    "success_with_code": "select count(*) from t where status = 'SUCCESS' and decline_code is not null",
    "decline_without_code": "select count(*) from t where status <> 'SUCCESS' and decline_code is null",
    "amount_positive": "select count(*) from t where not amount > 0",
    "amount_at_least_50": "select count(*) from t where not amount >= 50",
    "event_type_domain": "select count(*) from l where event_type not in ('payment.success', 'payment.failed', 'payment.pending')",
    "attempts_at_least_1": "select count(*) from l where not delivery_attempts >= 1",
    "latency_positive": "select count(*) from l where not latency_ms > 0",
    "merchant_id_format": "select count(*) from m where not regexp_full_match(merchant_id, 'merchant_id_[0-9]+')",
    "webhook_url_https": "select count(*) from m where not starts_with(webhook_url, 'https://')",
    "one_log_per_transaction": """select count(*) from (select t.transaction_id, count(log_id) as n
 from t left join l using (transaction_id) group by 1) where n <> 1""",
}

_REMEDY = """case when status = 'DECLINED' then 'NOTHING_TO_DELIVER' when http_status between 500 and 599 then 'RETRY'
 when http_status = 401 then 'ROTATE_SECRET' when http_status = 400 then 'CLIENT_ERROR' when http_status = 404 then 'FIX_URL'
 when http_status between 200 and 299 then 'OK' else 'REVIEW' end"""

_SHUFFLED = "(cast(substr(transaction_id, 5) as bigint) * 1103515245) % 8589934592"

_PROMISE = r"""(?i)(?:I''?ll|I will|I am going to|I''m going to|let me|I need to)\s+(?:check|search|look\s*(?:up|into)|query|consult|retrieve|access|investigate|find)[^.!?]{0,80}?\s*(?:knowledge\s*base|KB|database|documentation|tool|system)"""
_CODE_IN = r"""nullif(regexp_extract({text}, '(?i)(?:decline[_ ]code|error[_ ]code|code)(?:\s*[:,]\s*|\s+(?:of|is|was)\s+|\s+)["'']?(\d{{1,3}}[_A-Za-z]\w*)["'']?', 1), '')"""
_STRIP = r"""regexp_replace(regexp_replace(regexp_replace(text,
 '\{"name": ?"(?:fetch_transaction_logs|retry_failed_webhook|search_knowledge_base|fetch_merchant_diagnostics|check_ml_system_alerts)"(?:[^{}]|\{[^{}]*\})*\}', '', 'g'),
 '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"""

ORACLES: dict[str, str] = {
    "features_1day": _sql("fd", f"select {_FEATURES} from fd"),
    "features_10min": _sql("t", _window("t", "10 minutes", 6)),
    "features_reduced": _sql("fd", """select merchant_id, total_transactions, decline_count,
 round(decline_ratio, 6) as decline_ratio, round(avg_amount, 6) as avg_amount from fd"""),
    "features_order_days": _sql("ot", _window("ot", "1 day", 4)),
    "alerts_classified": _sql("fd", """select merchant_id, "timestamp", risk_block_count,
 case when risk_block_count > 1 then 'High Risk Block Spike' when decline_ratio > 0.6 then 'Elevated Decline Ratio'
 else 'General Transaction Anomaly' end as alert_type, cast(printf('%.4f', decline_ratio) as double) as decline_ratio,
 total_transactions from fd"""),
    "alert_descriptions": _sql("al", 'select merchant_id, window_start as "timestamp", description from al'),
    "alert_records": _sql("al", """select merchant_id, strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') as window_start, alert_type,
 description, decline_ratio, total_transactions from al where decline_ratio > 0.6"""),
    "alert_json": _sql("al", """select merchant_id, '{"merchant_id":"' || merchant_id || '","timestamp":"'
 || strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') || '","alert_type":"' || alert_type || '","metrics":{"decline_ratio":'
 || decline_ratio || ',"total_transactions":' || total_transactions || '}}' as alert_json from al where decline_ratio > 0.6"""),
    "alerts_by_merchant": _sql("m al", """select m.merchant_id, coalesce('ALERT FOUND: [' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ')
 || '] - ' || description, 'No active ML alerts for ' || m.merchant_id || '.') as message
 from m left join (select * from al where decline_ratio > 0.6) a on a.merchant_id = m.merchant_id"""),
    "new_alerts": _sql("al", """select merchant_id, window_start, description from al
 where decline_ratio > 0.6 and window_start > timestamp '2024-01-15'"""),
    "merchant_lookup": _sql("m", """select * from m where merchant_id in
 (select 'merchant_id_' || (user_id + (event_id % 3) * 150000) from events)"""),
    "merchant_not_found": _sql("m", """select distinct merchant_id, '''' || merchant_id || ''' not found.' as detail
 from (select 'merchant_id_' || (user_id + (event_id % 3) * 150000) as merchant_id from events)
 where merchant_id not in (select merchant_id from m)"""),
    "txn_lookup": _sql("t l", "select * from t where transaction_id in (select transaction_id from l where http_status >= 500)"),
    "first_log_per_txn": _sql("ll", """select * exclude (rn) from (select *, row_number() over (partition by transaction_id
 order by log_id, "timestamp", http_status, delivery_attempts) as rn from ll) where rn = 1"""),
    "txn_details_with_log": _sql("j", """select transaction_id, merchant_id, status, decline_code, log_id is not null as has_log,
 log_id, http_status, delivery_attempts from j"""),
    "webhook_update": _sql("l up", """select log_id, transaction_id, "timestamp", event_type,
 case when log_id in (select log_id from up) then 200 else http_status end as http_status, delivery_attempts, latency_ms from l"""),
    "webhook_update_unmatched": _sql("l up", "select log_id, 200 as new_http_status from up where log_id not in (select log_id from l)"),
    "retry_outcomes": _sql("l up", """select l.log_id is not null as success, up.log_id,
 case when l.log_id is not null then 200 end as new_http_status, 'Webhook log ''' || up.log_id || case when l.log_id is not null
 then ''' has been marked as successfully retried (http_status → 200).' else ''' not found.' end as message
 from up left join l on l.log_id = up.log_id"""),
    "records_nan_to_null": _sql("t", "select transaction_id, case when card_bin <> '411111' then amount end as amount from t"),
    "numeric_columns_only": "select o_orderkey, o_custkey, o_totalprice from orders",
    "column_defaults": _sql("t", "select transaction_id, '' as decline_code, amount from t"),
    "numeric_coercion": """select event_id, case when event_id % 5 = 0 or event_id % 7 = 0 then 0.0::double
 else cast(regexp_extract(props, '([0-9]+)', 1) as double) end as number from events""",
    "boolean_filters": _sql("j", """select transaction_id, merchant_id, amount, http_status from j where http_status = 401
 or (merchant_id = 'merchant_id_2' and amount >= 1 and amount <= 50 and decline_code is null)"""),
    "time_range_filters": """select count(*) filter (ts between timestamp '2024-01-10' and timestamp '2024-01-11') as closed,
 count(*) filter (ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11') as half_open from events""",
    "membership_filter": _sql("t", """select transaction_id, decline_code from t
 where decline_code in ('14_Invalid_Card_Number', '54_Expired_Card')"""),
    "prefix_filter": _sql("l", "select log_id, http_status from l where log_id like 'WH-0000%'"),
    "txn_log_left_join": _sql("j", "select * from j"),
    "order_line_left_join": _sql("ot ll", """select status, http_status, count(*) as n, round(sum(amount), 2) as amount
 from ot left join ll using (transaction_id) group by 1, 2"""),
    "merchant_logs_semi": _sql("t l", """select * from l where transaction_id in
 (select transaction_id from t where merchant_id = 'merchant_id_2')"""),
    "planted_log_semi": _sql("t l", """select * from l where transaction_id in
 (select transaction_id from t where decline_code in ('14_Invalid_Card_Number', '54_Expired_Card'))"""),
    "merchant_category_join": _sql("t m", """select mcc_code, count(*) as n, round(sum(amount), 2) as amount
 from t left join m using (merchant_id) group by 1"""),
    "decline_kb_lookup": _sql("t kb", """select transaction_id, decline_code, code, title, meaning, expect, action
 from t left join kb on code = regexp_extract(decline_code, '^([0-9]+)', 1) where decline_code is not null"""),
    "fk_orphans": _sql("t l m", """select 'txn_without_log' as check_name, count(*) as orphans from t where transaction_id not in (select transaction_id from l)
 union all select 'log_without_txn', count(*) from l where transaction_id not in (select transaction_id from t)
 union all select 'txn_without_merchant', count(distinct merchant_id) from t where merchant_id not in (select merchant_id from m)
 union all select 'merchant_without_txn', count(*) from m where merchant_id not in (select merchant_id from t)"""),
    "success_counts": _sql("t", """select count(*) as total, count(*) filter (status = 'SUCCESS') as success_count,
 count(*) filter (status <> 'SUCCESS') as non_success_count from t"""),
    "success_rate": _sql("t", f"""select total, success_count, {_pct('success_count', 'total')} as success_rate
 from (select count(*) as total, count(*) filter (status = 'SUCCESS') as success_count from t)"""),
    "success_rate_by_merchant": _sql("t", f"""select merchant_id, total, success_count, {_pct('success_count', 'total')} as success_rate
 from (select merchant_id, count(*) as total, count(*) filter (status = 'SUCCESS') as success_count from t group by 1)"""),
    "webhook_success_rate": _sql("l", f"""select total, delivered, {_pct('delivered', 'total')} as webhook_success_rate
 from (select count(*) as total, count(*) filter (http_status between 200 and 299) as delivered from l)"""),
    "critical_failures": _sql("j", """select count(*) filter (decline_code = '93_Risk_Block') as risk_blocks,
 count(*) filter (http_status = 500) as http_500,
 count(*) filter (decline_code = '93_Risk_Block') + count(*) filter (http_status = 500) as critical_failures from j"""),
    "failed_transactions": _sql("j", f"select transaction_id, merchant_id, status, decline_code, http_status from j where {_FAILED}"),
    "decline_code_frequency": _sql("t", "select decline_code, count(*) as n from t where decline_code is not null group by 1"),
    "decline_distribution": _sql("ot", """select decline_code, count(*) as n from ot
 where status <> 'SUCCESS' and decline_code is not null group by 1"""),
    "http_status_frequency": _sql("l", "select http_status, count(*) as n from l group by 1"),
    "merchant_diagnostics": _sql("m rt rl", _REPORT),
    "table_summary": _sql("t", _summary("t")),
    "order_summary": _sql("ot", _summary("ot")),
    "label_counts": _sql("t", """select tag, count(*) as n from (select case when decline_code = '93_Risk_Block' and row_number() over
 (partition by coalesce(decline_code = '93_Risk_Block', false) order by "timestamp", transaction_id) <= 50
 then 'ANOM1_RISK_BLOCK' end as tag from t) group by 1"""),
    "distinct_values": _sql("j", """select 'merchant_id' as column_name, count(distinct merchant_id) as distinct_values from j
 union all select 'card_bin', count(distinct card_bin) from j union all select 'decline_code', count(distinct decline_code) from j
 union all select 'http_status', count(distinct http_status) from j"""),
    "volume_concentration": _sql("t", """select count(*) as merchants, max(n) as top_count, min(n) as bottom_count,
 round(max(n) / min(n)::double, 6) as top_bottom_ratio, round(stddev_samp(n), 6) as count_stddev
 from (select merchant_id, count(*) as n from t group by 1)"""),
    "hour_counts": "select cast(hour(ts) as int) as hour_utc, count(*) as n from events group by 1",
    "hourly_profile": """select cast(sum(n) as bigint) as total, cast(sum(n) filter (h between 5 and 9) as bigint) as peak_count,
 cast(sum(n) filter (h between 20 and 23) as bigint) as off_peak_count, round(stddev_samp(n), 6) as hour_stddev
 from (select hour(ts) as h, count(*) as n from events group by 1)""",
    "burst_span": _sql("t", """select decline_code, count(*) as n, min("timestamp") as first_at, max("timestamp") as last_at,
 round(epoch_us(max("timestamp")) / 1e6 - epoch_us(min("timestamp")) / 1e6, 6) as span_seconds
 from t where decline_code is not null group by 1"""),
    "recent_txns_topn": _sql("rt", 'select merchant_id, rank, transaction_id, "timestamp" from rt where rank <= 10'),
    "recent_txns_one_merchant": _sql("t", """select * from t where merchant_id = 'merchant_id_3'
 order by "timestamp" desc, transaction_id limit 10"""),
    "recent_logs_topn": _sql("rl", 'select merchant_id, rank, log_id, "timestamp", http_status from rl where rank <= 10'),
    "recent_logs_one_merchant": _sql("lm", """select * exclude (merchant_id) from lm where merchant_id = 'merchant_id_2'
 order by "timestamp" desc, log_id limit 10"""),
    "retry_preview": _sql("rl", "select merchant_id, rank, log_id, http_status, event_type from rl where rank <= 5"),
    "first_success_per_merchant": _sql("t", """select * from (select merchant_id, row_number() over (partition by merchant_id
 order by "timestamp", transaction_id)::int as rank, transaction_id from t where status = 'SUCCESS') where rank <= 5"""),
    "first_declines": _sql("t", """select transaction_id, "timestamp" from t where status = 'DECLINED'
 order by "timestamp", transaction_id limit 50"""),
    "sequential_ids": f"""select o_orderkey, o_orderdate, 'TXN-' || {_ID.format(n='rn')} as transaction_id
 from (select *, row_number() over (order by o_orderdate, o_orderkey) - 1 as rn from orders)""",
    "union_feeds": _sql("t ot", f"""select * from t union all by name select * replace ('TXN-ORD-' || {_ID.format(n='transaction_id')} as transaction_id) from ot"""),
    "key_set_difference": _sql("t l", """select transaction_id, 'left' as only_in from t where transaction_id not in (select transaction_id from l)
 union all select transaction_id, 'right' from l where transaction_id not in (select transaction_id from t)"""),
    "timestamp_functions": _sql("t", """select transaction_id, date_trunc('second', "timestamp") as parsed,
 strftime("timestamp", '%Y-%m-%dT%H:%M:%S+00:00') as iso_offset, strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') as iso_zulu,
 "timestamp" + to_seconds(length(merchant_id)) as later from t"""),
    "live_feature_vector": _sql("lv", """select transaction_id, amount, is_declined::double as is_declined, is_risk_block::double as is_risk_block,
 is_webhook_401::double as is_webhook_401, is_webhook_error::double as is_webhook_error, hour_of_day, 0.0::double as no_such_feature from lv"""),
    "recoded_events": """select o_orderkey, case o_orderstatus when 'F' then 'payment.success' when 'P' then 'payment.failed'
 else 'payment.pending' end as event_type, greatest(o_totalprice, 50000.0) as clipped from orders""",
    "rounded_amounts": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(printf('%.4f', x) as double) as d4,
 cast(printf('%.1f', x) as double) as d1, printf('%.2f', x) as text
 from (select *, l_extendedprice * l_discount as x from lineitem)""",
    "extracted_transaction_ids": _sql("t", """select transaction_id, case when card_bin = '411111' then ''
 when card_bin = '400011' then lower(transaction_id) else transaction_id end as found from t"""),
    "field_queries": _sql("j", """select transaction_id, coalesce(nullif(concat_ws(' ', 'decline_code ' || decline_code,
 'http_status ' || http_status), ''), 'general FinTech query') as query from j"""),
    "json_round_trip": _sql("t", f"""select transaction_id, merchant_id, amount, status, decline_code, http as webhook_http_status
 from t join (select 'TXN-' || {_EVENT_ID} as transaction_id, case when event_id % 50 = 7 then null else {_HTTP} end as http from events) using (transaction_id)"""),
    "detect_risk_block": _sql("t", """select merchant_id, time_bucket(interval '1 day', "timestamp") as window_start, count(*) as risk_blocks
 from t where status = 'DECLINED' and decline_code = '93_Risk_Block' group by 1, 2 having count(*) >= 2"""),
    "detect_auth_failure": _sql("lm", """select merchant_id, time_bucket(interval '1 day', "timestamp") as window_start, count(*) as logs,
 count(*) filter (http_status = 401) as unauthorized, round(count(*) filter (http_status = 401) / count(*)::double, 6) as unauthorized_share
 from lm group by 1, 2 having count(*) >= 2 and count(*) filter (http_status = 401) / count(*)::double >= 0.5"""),
    "detect_card_testing": _sql("t", """select merchant_id, window_start, n as small_txns, round(dec / n::double, 6) as declined_share,
 round(case when dec > 0 then codes / dec::double else 0.0 end, 6) as test_code_share from (
 select merchant_id, time_bucket(interval '1 day', "timestamp") as window_start, count(*) as n, count(*) filter (status = 'DECLINED') as dec,
 count(*) filter (decline_code in ('14_Invalid_Card_Number', '54_Expired_Card')) as codes
 from t where amount between 1 and 5 group by 1, 2) where n >= 2"""),
    "detect_issuer_outage": _sql("t", """select * replace (round(issuer_down_share, 6) as issuer_down_share) from (
 select card_bin, time_bucket(interval '1 day', "timestamp") as window_start, count(*) as txns,
 count(*) filter (decline_code = '91_Issuer_Switch_Inoperative') as issuer_down,
 count(*) filter (decline_code = '91_Issuer_Switch_Inoperative') / count(*)::double as issuer_down_share from t group by 1, 2)
 where txns >= 5 and issuer_down_share >= 0.1"""),
    "detect_overload": _sql("j", """, v as (select merchant_id, time_bucket(interval '1 day', "timestamp") as window_start, count(*) as txns,
 count(log_id) as logs, count(*) filter (http_status = 504 and latency_ms > 5000) as overloaded from j group by 1, 2),
 b as (select merchant_id, avg(txns) as mean_txns from v group by 1)
 select merchant_id, window_start, txns, round(mean_txns, 6) as mean_txns, overloaded,
 round(overloaded / logs::double, 6) as overload_share from v join b using (merchant_id)
 where txns >= mean_txns and overloaded >= 1 and overloaded / logs::double >= 0.25"""),
    "stream_ledger_balance": _sql("dk", """select merchant_id, count(*) as rows_in, count(*) filter (kind = 'event') as events,
 count(*) filter (kind = 'duplicate') as duplicates, count(*) filter (kind = 'late') as lates from dk group by 1"""),
    "stream_ledger_alerts": _sql("lw", """select merchant_id, window_start, 'unauthorized' as what, unauthorized as hits, logs
 from lw where logs >= 2 and unauthorized / logs::double >= 0.5
 union all select merchant_id, window_start, 'overloaded', overloaded, logs
 from lw join (select merchant_id, avg(txns) as mean_txns from lw group by 1) using (merchant_id)
 where txns >= mean_txns and overloaded >= 1 and overloaded / logs::double >= 0.25"""),
    "detect_risk_block_sliding": _sql("t", _bursts("select * from t where status = 'DECLINED' and decline_code = '93_Risk_Block'", "merchant_id",
        {"risk_blocks": "1"}, 86400, "risk_blocks >= 2", ["risk_blocks"])),
    "detect_auth_failure_sliding": _sql("lm", _bursts("select * from lm", "merchant_id",
        {"logs": "1", "unauthorized": "cast(http_status = 401 as int)"}, 86400, "logs >= 2 and unauthorized / logs::double >= 0.5", ["unauthorized"])),
    "detect_card_testing_sliding": _sql("t", _bursts("select * from t where amount between 1 and 5", "merchant_id",
        {"small_txns": "1", "test_codes": "cast(coalesce(decline_code in ('14_Invalid_Card_Number', '54_Expired_Card'), false) as int)"},
        86400, "small_txns >= 2", ["small_txns", "test_codes"])),
    "detect_issuer_outage_sliding": _sql("t", _bursts("select * from t", "card_bin",
        {"txns": "1", "issuer_down": "cast(coalesce(decline_code = '91_Issuer_Switch_Inoperative', false) as int)"},
        86400, "txns >= 5 and issuer_down / txns::double >= 0.1", ["issuer_down"])),
    "detect_overload_sliding": _sql("j", _bursts("""select merchant_id, "timestamp", log_id is not null as has_log,
 coalesce(http_status = 504 and latency_ms > 5000, false) as over from j""", "merchant_id",
        {"txns": "1", "logs": "cast(has_log as int)", "overloaded": "cast(over as int)"}, 86400,
        """txns >= (select avg(n) from (select count(*) as n from j where j.merchant_id = tot.merchant_id group by time_bucket(interval '1 day', "timestamp")))
 and overloaded >= 1 and overloaded / logs::double >= 0.25""", ["txns", "overloaded"])),
    "detect_reconciliation_gap": _sql("j", """select transaction_id, merchant_id, amount, log_id, http_status, delivery_attempts
 from j where status = 'SUCCESS' and http_status = 500 and delivery_attempts >= 3"""),
    "remediation_class": _sql("t l", f"""select log_id, transaction_id, merchant_id, http_status, {_REMEDY} as remediation
 from l left join t using (transaction_id)"""),
    "bulk_retry": _sql("t l", """select log_id, case when status = 'SUCCESS' and http_status between 500 and 599 then 200 else http_status end as http_status,
 delivery_attempts from l left join t using (transaction_id)"""),
    "bulk_retry_outcomes": _sql("t l", """select true as success, log_id, 200 as new_http_status, 'Webhook log ''' || log_id
 || ''' has been marked as successfully retried (http_status → 200).' as message
 from l join t using (transaction_id) where status = 'SUCCESS' and http_status between 500 and 599"""),
    "triage_steps": _sql("j", f"""select transaction_id, merchant_id, log_id, concat_ws('>', case when decline_code is not null then 'LOOK_UP_CODE' end,
 case when http_status between 500 and 599 then 'RETRY_WEBHOOK' end, 'REPORT') as steps from j where {_FAILED}"""),
    "inject_labels": _sql("t", f""", f as (select *, status = 'DECLINED' and row_number() over (partition by status order by "timestamp", transaction_id) <= 50 as first50,
 card_bin = '411111' and row_number() over (partition by card_bin order by {_SHUFFLED}) <= ceil(0.9 * count(*) over (partition by card_bin)) as cut from t)
 select transaction_id, case when first50 or cut then 'DECLINED' else status end as status,
 case when cut then '91_Issuer_Switch_Inoperative' when first50 then '93_Risk_Block' else decline_code end as decline_code,
 case when first50 then 'ANOM1_RISK_BLOCK' when cut then 'ANOM4_ISSUER_DOWN' end as tag from f"""),
    "inject_dropped_webhooks": _sql("t", """select transaction_id, case when status = 'SUCCESS' and row_number() over
 (partition by merchant_id, status order by "timestamp", transaction_id) <= 5 then 'ANOM6_DROPPED_WEBHOOK' end as tag from t"""),
    "ground_truth": _sql("pr", "select transaction_id, y_true as is_anomaly_actual from pr"),
    "outcome_labels": _sql("pr", """select transaction_id, case when y_pred = 1 and y_true = 1 then 'TP (True Positive)'
 when y_pred = 1 then 'FP (False Positive)' when y_true = 1 then 'FN (False Negative)' else 'TN (True Negative)' end as outcome from pr"""),
    "confusion_counts": _sql("pr", """select status, count(*) filter (y_pred = 1 and y_true = 1) as tp, count(*) filter (y_pred = 1 and y_true = 0) as fp,
 count(*) filter (y_pred = 0 and y_true = 1) as fn, count(*) filter (y_pred = 0 and y_true = 0) as tn from pr group by 1"""),
    "confusion_matrix": _sql("pr", """select count(*) filter (y_pred = 1 and y_true = 1) as tp, count(*) filter (y_pred = 1 and y_true = 0) as fp,
 count(*) filter (y_pred = 0 and y_true = 1) as fn, count(*) filter (y_pred = 0 and y_true = 0) as tn from pr"""),
    "precision_recall_f1": _sql("sc", """select model, tp, fp, fn, tn, round(precision, 6) as precision, round(recall, 6) as recall,
 round(f1, 6) as f1 from sc"""),
    "metrics_long": _sql("sc", """select model, 'Precision' as metric, round(precision, 6) as score from sc
 union all select model, 'Recall', round(recall, 6) from sc union all select model, 'F1-Score', round(f1, 6) from sc"""),
    "metrics_pivot": _sql("sc", "select model, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from sc"),
    "best_model": _sql("sc", "select model, round(f1, 6) as f1 from sc order by sc.f1 desc, model limit 1"),
    "quality_report": _sql("m t l", " union all ".join(
        f"select '{name}' as check_name, ({body}) as violations" for name, body in _CHECKS.items())),
    "error_code_check": _sql("ing", """select 'error_code_only_when_failed' as check_name, count(*) as violations
 from ing where problem is null and status <> 'FAILED' and error_code is not null"""),
    "ingest_validated": _sql("ing", """select transaction_id, merchant_id, amount, currency, status, error_code, true as received,
 'Payment event for transaction ' || transaction_id || ' acknowledged.' as message from ing where problem is null"""),
    "ingest_quarantine": _sql("ing", "select event_id, problem from ing where problem is not null"),
    "iforest_frozen_scores": _sql("fs", """select transaction_id, round(s, 6) as anomaly_score, round(-s + 0.5, 6) as decision,
 case when s > 0.5 then 1 else 0 end as prediction from fs"""),
    "scaled_features": _sql("lf", """, s as (select avg(amount) as ma, stddev_pop(amount) as sa, avg(http_status) as mh, stddev_pop(http_status) as sh,
 avg(delivery_attempts) as md, stddev_pop(delivery_attempts) as sd from lf)
 select transaction_id, round((amount - ma) / sa, 6) as amount, round((http_status - mh) / sh, 6) as http_status,
 round((delivery_attempts - md) / sd, 6) as delivery_attempts, y_true from lf, s"""),
    "lof_scores": _sql("lf", """, s as (select avg(amount) as ma, stddev_pop(amount) as sa, avg(http_status) as mh, stddev_pop(http_status) as sh,
 avg(delivery_attempts) as md, stddev_pop(delivery_attempts) as sd from lf),
 x as (select transaction_id, y_true, (amount - ma) / sa as a, (http_status - mh) / sh as b, (delivery_attempts - md) / sd as c from lf, s),
 tr as (select a, b, c, count(*) as w from x where y_true = 0 group by all),
 best as (select p.a, p.b, p.c, min_by({'a': t.a, 'b': t.b, 'c': t.c, 'w': t.w, 'd': sqrt(power(p.a - t.a, 2) + power(p.b - t.b, 2) + power(p.c - t.c, 2))},
 {'r': round(power(p.a - t.a, 2) + power(p.b - t.b, 2) + power(p.c - t.c, 2), 12), 'a': t.a, 'b': t.b, 'c': t.c}, 3) as f
 from (select distinct a, b, c from x) p, tr t group by all),
 hits as (select best.a, best.b, best.c, unnest(f) as h, generate_subscripts(f, 1) as i from best),
 own as (select hits.a, hits.b, hits.c, i, h.a as na, h.b as nb, h.c as nc, h.d as d, case when h.d = 0 then h.w - 1 else h.w end as w
 from hits join tr on hits.a = tr.a and hits.b = tr.b and hits.c = tr.c),
 other as (select a, b, c, i, h.a as na, h.b as nb, h.c as nc, h.d as d, h.w as w from hits where i <= 2),
 own_taken as (select * from (select *, greatest(0, least(w, 2 - (sum(w) over (partition by a, b, c order by i) - w))) as take from own) where take > 0),
 other_taken as (select * from (select *, greatest(0, least(w, 2 - (sum(w) over (partition by a, b, c order by i) - w))) as take from other) where take > 0),
 reach as (select a as na, b as nb, c as nc, max(d) as kd from own_taken group by all),
 dense as (select a as na, b as nb, c as nc, 1.0 / (sum(take * greatest(kd, d)) / sum(take) + 1e-10) as density
 from own_taken join reach using (na, nb, nc) group by all),
 own_score as (select a, b, c, sum(take * n.density) / sum(take) / any_value(o.density) as score
 from own_taken join dense n using (na, nb, nc) join dense o on o.na = a and o.nb = b and o.nc = c group by a, b, c),
 edge as (select quantile_cont(score, 0.8) as edge from x join own_score using (a, b, c) where y_true = 0),
 other_dense as (select a, b, c, 1.0 / (sum(take * greatest(kd, d)) / sum(take) + 1e-10) as density
 from other_taken join reach using (na, nb, nc) group by all),
 other_score as (select a, b, c, sum(take * n.density) / sum(take) / any_value(o.density) as score
 from other_taken join dense n using (na, nb, nc) join other_dense o using (a, b, c) group by a, b, c)
 select transaction_id, y_true, round(log10(score), 6) as log_score, cast(score > edge * (1 + 1e-9) as int) as prediction
 from x join other_score using (a, b, c), edge"""),
    "mahalanobis": _sql("lf", """, s as (select avg(amount) as ma, avg(http_status) as mh, var_pop(amount) as va, var_pop(http_status) as vh,
 covar_pop(amount, http_status) as cv from lf)
 select transaction_id, round((power(amount - ma, 2) * vh - 2 * (amount - ma) * (http_status - mh) * cv + power(http_status - mh, 2) * va)
 / (va * vh - cv * cv), 6) as d2 from lf, s"""),
    "topk_vectors": _sql("hit", "select query_id, vec_id, round(score, 6) as score, rank from hit where rank <= 5"),
    "kb_answer": _sql("hit", """select query_id, string_agg('[Source ' || rank || ': group-' || label || ']' || chr(10) || 'passage ' || vec_id,
 chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank) as answer
 from hit join embeddings using (vec_id) where rank <= 2 group by 1"""),
    "kb_search_documents": _KB_LINES + """,
 scored as (select query_id, vec_id, sum(q.weight * p.weight) as score from q join p using (bucket) group by 1, 2),
 ranked as (select *, row_number() over (partition by query_id order by round(score, 9) desc, vec_id)::int as rank from scored)
 select query_id, vec_id, round(score, 6) as score, rank from ranked where rank <= 2""",
    "kb_search_pairs": _KB_LINES + """ select (select count(*) from benchmark) as questions, (select count(distinct text) from lines) as lines, true as below_a_quarter""",
    "transcript_flags": _sql("tf", "select conv_id, turn, role, is_incomplete, has_tool_call, has_raw_json, decline_code from tf"),
    "transcript_clean": _sql("tr", f"select conv_id, turn, {_STRIP} as clean_text from tr"),
    "transcript_repair": _sql("tf kb", rf""", cl as (select conv_id, turn, has_tool_call, {_STRIP} as clean from tf),
 fl as (select *, has_tool_call or regexp_matches(clean, '{_PROMISE}') as needs, {_CODE_IN.format(text="clean")} as named from cl)
 select conv_id, turn, case when not needs then 'OK' when code is not null then 'REPAIRED' else 'NEEDS_RETRY' end as repair_status,
 case when needs and code is not null then regexp_replace(regexp_replace(regexp_replace(clean, '{_PROMISE}', '', 'g'), '\s+$', ''), '[ .]+$', '')
 || '.' || chr(10) || chr(10) || 'According to our knowledge base, decline code **' || named || '** means the following:' || chr(10) || chr(10)
 || concat_ws(chr(10) || chr(10), 'Meaning: ' || meaning, 'When to Expect It: ' || expect, 'Merchant Action: ' || action) else clean end as repaired_text
 from fl left join kb on code = regexp_extract(named, '^([0-9]+)', 1)"""),
    "transcript_audit": _sql("tf", f"select role, {_AUDIT}"),
    "transcript_audit_by_conversation": _sql("tf", f"select conv_id, {_AUDIT}"),
    "live_alerts_batch": _sql("fs", """select transaction_id, merchant_id, 'stream' as source, round(-s + 0.5, 6) as anomaly_score
 from fs where s > 0.5"""),
    "contamination_share": "select 0.1::double as flagged_share",
    "csv_round_trip": _sql("m", "select * from m"),
    "csv_missing_file": _sql("m", "select count(*) as merchants, 0::bigint as logs from m"),
    "validated_scan": _sql("t", """select * exclude (card_bin) replace (date_trunc('second', "timestamp") as "timestamp") from t"""),
    "published_messages": _sql("t", """select transaction_id, merchant_id, amount, decline_code,
 strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') as "timestamp" from t"""),
    "alert_table_round_trip": _sql("al", """select merchant_id, strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') as window_start, alert_type,
 description from al where decline_ratio > 0.6"""),
    "passage_store_round_trip": "select label, count(*) as n, min(len(embedding)) as dims, sum(vec_id) as ids from embeddings group by label",
    "merged_view_empty_sides": _sql("t l", "select transaction_id as id, 'transaction' as kind from t union all select log_id, 'log' from l"),
    "empty_features": _sql("fd", "select 0::bigint as of_none, count(*) as of_all from fd"),
    "chunk_properties_by_document": """select doc_id, length(trim(text, ' \n')) > 0 as has_chunks, true as parts_of_text, true as short_enough
 from documents""",
    "outlier_properties": "select * from (values ('EllipticEnvelope', true, true), ('AutoEncoder', true, true)) v(model, within_share, in_order)",
    "webhook_kb_lookup": _sql("l ws", "select log_id, http_status, status_meaning, gateway_action from l left join ws using (http_status)"),
}
ORACLES["webhook_update_stored"] = ORACLES["webhook_update"]
ORACLES["bulk_retry_stored"] = ORACLES["bulk_retry"]
ORACLES["stream_scoring"] = ORACLES["live_alerts_batch"]
ORACLES["stream_features"] = ORACLES["features_1day"]
ORACLES["iforest_frozen_scores_udf"] = ORACLES["model_round_trip"] = ORACLES["iforest_frozen_scores"]
