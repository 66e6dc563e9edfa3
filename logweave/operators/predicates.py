"""Record predicates. Every one is NULL-safe: a missing field, a record that
is not an object, or a failed conversion gives ``false`` (never NULL), so
predicates compose with ``&``/``|`` and drop bad records instead of
failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.functions.common import to_col

# Business log types (compared in lower case).
CURRENCY_LOG_TYPES = ["currency_a", "currency_b", "currency_c", "currency_d"]
BUY_LOG_TYPES = ["exchange_buy", "layby_buy"]
# Pipe-log table names kept by the chat filter.
CHAT_TABLES = ["chatlogflow", "chatflow"]
# Game log names kept by the daily feed (any case).
TARGET_LOG_NAMES = ["logtype1", "logtype2"]


def _safe(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def field_equals(var, field: str, value: str) -> Column:
    return _safe(J.text_of(to_col(var), field) == F.lit(value))


def field_not_startswith(var, field: str, prefix: str) -> Column:
    return _safe(~J.text_of(to_col(var), field).startswith(prefix))


def in_ci(text: Column, values: list[str]) -> Column:
    """Case-insensitive membership of an already-read text."""
    return _safe(F.lower(text).isin([v.lower() for v in values]))


def field_in_ci(var, field: str, values: list[str]) -> Column:
    """Case-insensitive membership of a text field."""
    return in_ci(J.text_of(to_col(var), field), values)


def currency_rule(currency_type: Column, log_type: Column, wanted: int = 1,
                  log_types: list[str] = CURRENCY_LOG_TYPES) -> Column:
    """Currency log: loose-int ``currency_type`` equals ``wanted`` and the
    lower-cased ``log_type`` is a currency type (from already-read fields)."""
    return _safe((currency_type == wanted) & F.lower(log_type).isin(log_types))


def buy_rule(log_type: Column, log_types: list[str] = BUY_LOG_TYPES) -> Column:
    return _safe(F.lower(log_type).isin(log_types))


def business_rule(currency_type: Column, log_type: Column) -> Column:
    return currency_rule(currency_type, log_type) | buy_rule(log_type)


def is_currency(var, currency_type: int = 1, log_types: list[str] = CURRENCY_LOG_TYPES) -> Column:
    """Currency rule read from a parsed record; either field missing -> false."""
    var = to_col(var)
    return currency_rule(J.int_of(var, "currency_type"), J.text_of(var, "log_type"), currency_type, log_types)


def is_buy(var, log_types: list[str] = BUY_LOG_TYPES) -> Column:
    return buy_rule(J.text_of(to_col(var), "log_type"), log_types)


def is_business(var) -> Column:
    return is_currency(var) | is_buy(var)


def not_null(c) -> Column:
    return to_col(c).isNotNull()
