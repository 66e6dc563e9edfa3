"""String column functions: delimited fields, topic names, hashing, masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.common import to_col


def _regex_quote(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?()[]{}|\/" else c for c in s)


def split_fields(text, delimiter: str = "|") -> Column:
    """Split like a JVM ``String.split``: trailing empty fields are dropped.

    ``a|b||`` gives ``[a, b]``, so a field index that lands on the empty
    tail counts as missing. Delimiter is a literal string.
    """
    q = _regex_quote(delimiter)
    t = to_col(text)
    stripped = F.regexp_replace(t, "(?:" + q + r")+\z", "")
    # An input made only of delimiters has no fields at all.
    return F.when((stripped == "") & (t != ""), F.array().cast("array<string>")).otherwise(
        F.split(stripped, q, -1))


def field_at(text, index: int, delimiter: str = "|") -> Column:
    """0-based delimited field; NULL when the record has no such field."""
    return F.get(split_fields(text, delimiter), index)


def cut_at_first(text, marker: str) -> tuple[Column, Column]:
    """``(before, from)`` around the first ``marker``; both NULL if absent."""
    t = to_col(text)
    i = F.instr(t, marker)
    found = i > 0
    return (F.when(found, F.substring(t, F.lit(1), i - 1)),
            F.when(found, F.substring(t, i, F.length(t))))


def key_head(key, separator: str) -> Column:
    """Text before the first ``separator`` of a composite key (NULL if none)."""
    k = to_col(key)
    return F.when(F.instr(k, separator) > 0, F.substring_index(k, separator, 1))


def composite_key(kind, ident, separator: str) -> Column:
    """``lower(kind) + separator + ident`` — spreads one kind over partitions."""
    return F.concat(F.lower(to_col(kind)), F.lit(separator), to_col(ident))


def sha256_hex(text) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text."""
    return F.sha2(to_col(text).cast("string"), 256)


# Masking patterns and tokens, applied in this order
# (card number, resident registration number, phone number). Digits around
# a match must not be digits, so longer numbers are left alone.
PII_RULES = [
    (r"(?<!\d)\d{4}-\d{4}-\d{4}-\d{4}(?!\d)", "**MASKED_CREDIT_CARD_NUM**"),
    (r"(?<!\d)\d{6}-\d{7}(?!\d)", "**MASKED_RRN**"),
    (r"(?<!\d)0\d{1,2}-\d{3,4}-\d{4}(?!\d)", "**MASKED_PHONE_NUM**"),
]


# Phone numbers as the document corpus writes them: +1 (743) 555-3824.
DOCUMENT_PII_RULES = [
    *PII_RULES,
    (r"(?<![\d+])\+\d{1,3} \(\d{2,4}\) \d{3,4}-\d{4}(?!\d)", "**MASKED_PHONE_NUM**"),
]


def mask_pii(text, rules=None) -> Column:
    """Replace card, resident and phone numbers with fixed tokens."""
    c = to_col(text)
    for pattern, token in rules or PII_RULES:
        c = F.regexp_replace(c, pattern, token)
    return c


def words(text) -> Column:
    """Whitespace tokens of a text (no empty tokens)."""
    return F.filter(F.split(to_col(text), r"\s+", -1), lambda w: w != "")
