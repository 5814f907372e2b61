"""Expressions that audit agent replies."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Tool names and phrase patterns the audit looks for.
TOOL_NAMES = (
    "fetch_transaction_logs",
    "retry_failed_webhook",
    "search_knowledge_base",
    "fetch_merchant_diagnostics",
    "check_ml_system_alerts",
)
INCOMPLETE_PATTERN = (
    r"(?:I'?ll|I will|I am going to|I'm going to|let me|I need to)\s+"
    r"(?:check|search|look\s*(?:up|into)|query|consult|retrieve|access|investigate|find)"
    r"[^.!?]{0,80}?\s*(?:knowledge\s*base|KB|database|documentation|tool|system)"
)
DECLINE_CODE_PATTERN = (
    r"(?:decline[_ ]code|error[_ ]code|code)(?:\s*[:,]\s*|\s+(?:of|is|was)\s+|\s+)"
    r"[\"']?(\d{1,3}[_A-Za-z]\w*)[\"']?"
)
RAW_JSON_PATTERN = r"(?:^|\n)\{"

# Unicode-aware classes and case folding, as the patterns assume.
_FLAGS = "(?iU)"


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _false_if_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_incomplete(text) -> Column:
    return _false_if_null(_c(text).rlike(_FLAGS + INCOMPLETE_PATTERN))


def has_tool_call(text) -> Column:
    return _false_if_null(_c(text).rlike('"name": ?"(?:' + "|".join(TOOL_NAMES) + ')"'))


def has_raw_json(text) -> Column:
    return _false_if_null(_c(text).rlike(RAW_JSON_PATTERN))


def decline_code_in(text) -> Column:
    return F.nullif(F.regexp_extract(_c(text), _FLAGS + DECLINE_CODE_PATTERN, 1), F.lit(""))


def without_promise(text) -> Column:
    """Text without the 'I'll check' phrase and without trailing blanks and dots."""
    bare = F.regexp_replace(_c(text), _FLAGS + INCOMPLETE_PATTERN, "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?U)\s+\z", ""), r"[ .]+\z", "")


def _names_a_tool(blob: str) -> bool:
    try:
        value = json.loads(blob)
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and value.get("name") in TOOL_NAMES


_BRACE_TOKENS = re.compile(r'"(?:\\.|[^"\\])*"|["{}]', re.DOTALL)


def _object_end(text: str, start: int) -> int:
    """Index after the object opening at start, or -1 when it never closes."""
    depth = 0
    for token in _BRACE_TOKENS.finditer(text, start):
        mark = token.group()
        if mark == '"':  # a quote that never closes
            return -1
        if mark == "{":
            depth += 1
        elif mark == "}":
            depth -= 1
            if not depth:
                return token.end()
    return -1


def drop_tool_calls(text: str | None) -> str | None:
    """Cut every balanced JSON object that names a tool; keep all other text."""
    if not text:
        return text
    kept, position = [], 0
    while (opening := text.find("{", position)) >= 0:
        kept.append(text[position:opening])
        end = _object_end(text, opening)
        if end < 0:
            position = opening
            break
        if not _names_a_tool(text[opening:end]):
            kept.append(text[opening:end])
        position = end
    kept.append(text[position:])
    return re.sub(r"\n{3,}", "\n\n", "".join(kept)).strip()


def strip_tool_calls(text) -> Column:
    """Arrow UDF over whole batches: nesting depth is unbounded, so no regex fits."""
    @pandas_udf("string")
    def strip(batch: pd.Series) -> pd.Series:
        return batch.map(drop_tool_calls, na_action="ignore")
    return strip(_c(text))
