"""JSON column functions: parse, validate, read fields, unwrap, error records.

Everything is a Catalyst expression (``try_parse_json`` + ``variant_get``
family), so it runs inside whole-stage codegen on batch and streaming
DataFrames alike. A record's JSON is parsed once into a VARIANT column and
every field read after that is a cheap lookup in the binary variant.

Semantics follow the usual tree-model JSON reader that log shippers are
consumed with:

* a *valid* JSON record is an object or an array; scalars (``"x"``, ``1``,
  ``true``, ``null``) parse but are not valid records;
* text after the first complete value is ignored (``{"a":1} x`` is valid);
* a repeated key keeps the last value (needs the session setting in
  :mod:`logweave.session`);
* single quotes, ``NaN`` and other non-standard tokens are rejected;
* numbers of up to 38 digits keep their exact decimal digits; a longer one
  is read as a double;
* a record beyond the size limits of the VARIANT reader (one string over
  20 MB) is read field by field by a second reader with the same rules; what
  that cannot hold either (over ``LARGEST`` bytes, or a repeated key in such a
  record) is *too large*, which jobs dead-letter with its own reason;
* both readers hold at most ``DEEPEST`` nested levels and numbers of
  ``LONGEST_NUMBER`` characters. Neither recurses beyond that, so a record
  that is well-formed but deeper, or has a longer number, costs its own
  parse and no more; jobs dead-letter it as *beyond the reader's limits*.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.common import to_col

# The three dead-letter reasons a record can carry.
INVALID_JSON = "Invalid JSON format"
FILEBEAT_ERROR = "Filebeat Message Deserialization Error"
FLUENTBIT_ERROR = "Fluentbit Log Deserialization Error"
# Reasons added here for failures the routing layer catches itself.
TRANSFORM_ERROR = "Record Transform Error"
TOPIC_ERROR = "Output Topic Resolution Error"
TOO_LARGE = "Record Too Large"
BEYOND_LIMITS = "Record Beyond Reader Limits"
NOT_UTF8 = "Record Is Not UTF-8"

#: Bytes of a record that one VARIANT value holds with room to spare (its limit is 128 MiB).
LARGEST = 100_000_000
#: Bytes beyond which the first reader may refuse a record for its size (one string of 20 MB).
FIRST_READER = 20_000_000
#: Nested levels and characters of a number that both readers hold.
DEEPEST, LONGEST_NUMBER = 1000, 1000
#: Open brackets beyond which a text is not even checked for its form.
HOPELESS = 1_000_000
_FORM = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": "2147483647"}
_STRICT = {**_FORM, "maxNestingDepth": str(DEEPEST), "maxNumLen": str(LONGEST_NUMBER)}
_UNBOUNDED = {**_FORM, "maxNestingDepth": str(HOPELESS), "maxNumLen": "2147483647", "columnNameOfCorruptRecord": "_bad"}

_JSON_SPACE = " \t\n\r"


def path_of(field: str) -> str:
    """JSON path for one top-level field name, whatever characters it has.

    A name that starts with ``$.`` is a path already (``$.a.b``).
    """
    if field.startswith("$."):
        return field
    if field.replace("_", "a").isalnum():
        return "$." + field
    if '"' in field:
        return "$['" + field + "']"
    return '$["' + field + '"]'


def parse(value) -> Column:
    """Lenient parse: text -> VARIANT; NULL when the text is not JSON (or too large)."""
    return or_large(value, F.try_parse_json(to_col(value)))


def or_large(text, first) -> Column:
    """The first reader's result, or the second reader's for a text too large for the first.

    The second reader runs outside compiled code; where ``first`` is a column
    of an earlier projection, only large texts are touched there.
    """
    text = to_col(text)
    return F.coalesce(to_col(first), F.when(F.octet_length(text) > FIRST_READER, _parse_large(text)))


def _parse_large(text: Column) -> Column:
    """The second reader: an object's fields or an array's items as VARIANT values."""
    c = first_char(text)
    fields = F.from_json(text, "map<string,variant>", _STRICT)
    items = F.from_json(text, "array<variant>", _STRICT)
    once = F.size(F.array_distinct(F.map_keys(fields))) == F.size(fields)
    fits = F.octet_length(text) <= LARGEST
    return (F.when(fits & (c == "{") & once, F.to_variant_object(fields))
            .when(fits & (c == "["), F.to_variant_object(items)))


def too_large(text, var) -> Column:
    """True where a text is not parsed for its size, not for its form (never NULL)."""
    return F.coalesce(to_col(var).isNull() & (F.octet_length(to_col(text)) > FIRST_READER), F.lit(False))


def beyond_limits(text, var) -> Column:
    """True where a text is well-formed but nested too deeply for the readers, or has too long a number (never NULL).

    Only a text that was not parsed and has that many open brackets or digits
    in a row is looked at; its form is then checked by a reader that skips
    all values, which takes no recursion and converts no number. With more
    than ``HOPELESS`` open brackets the form is left unchecked.
    """
    text = to_col(text)
    opens = F.length(text) - F.length(F.translate(text, "[{", ""))
    suspect = (opens > DEEPEST) | text.rlike(f"[0-9]{{{LONGEST_NUMBER}}}")
    probe = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "n int, _bad string", _UNBOUNDED)
    return F.coalesce(to_col(var).isNull() & suspect & ((opens > HOPELESS) | probe["_bad"].isNull()), F.lit(False))


def first_char(text) -> Column:
    """First non-whitespace character of a JSON text."""
    return F.substring(F.ltrim(to_col(text), F.lit(_JSON_SPACE)), 1, 1)


def is_container(text, var=None) -> Column:
    """True when ``text`` parses to a JSON object or array.

    The parse tells whether the text is JSON; the first non-blank
    character then tells object/array from scalar without walking the
    document (cheaper than ``schema_of_variant`` on large records).
    Pass an already-parsed ``var`` to avoid parsing twice.
    """
    text = to_col(text)
    var = parse(text) if var is None else to_col(var)
    return F.coalesce(var.isNotNull() & first_char(text).isin("{", "["), F.lit(False))


def is_valid_json(text) -> Column:
    """Object-or-array check on a text column (never NULL)."""
    return is_container(text)


def is_parseable_json(text) -> Column:
    """Plain parse check: scalars count as parseable (never NULL)."""
    return F.coalesce(parse(text).isNotNull(), F.lit(False))


def json_kind(text, var=None) -> Column:
    """'object' | 'array' | 'scalar', or NULL when the text is not JSON."""
    text = to_col(text)
    var = parse(text) if var is None else to_col(var)
    c = first_char(text)
    return (F.when(var.isNull(), F.lit(None).cast("string"))
            .when(c == "{", F.lit("object"))
            .when(c == "[", F.lit("array"))
            .otherwise(F.lit("scalar")))


def has_field(var, field: str) -> Column:
    """True when the parsed record has the field (a JSON null counts)."""
    return F.coalesce(F.try_variant_get(to_col(var), path_of(field), "variant").isNotNull(),
                      F.lit(False))


def node(var, field: str) -> Column:
    """The field as a VARIANT (NULL when missing)."""
    return F.try_variant_get(to_col(var), path_of(field), "variant")


def text_of(var, field: str) -> Column:
    """Field as text, the way a tree-model reader's ``asText`` reads it.

    missing -> NULL; JSON null -> ``'null'``; object/array -> ``''``;
    string -> its value; number/boolean -> its literal text.
    """
    var = to_col(var)
    p = path_of(field)
    s = F.try_variant_get(var, p, "string")
    v = F.try_variant_get(var, p, "variant")
    nested = F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
    return (F.when(s.isNull(), F.when(F.is_variant_null(v), F.lit("null")))
            .when((s.startswith("{") | s.startswith("[")) & nested, F.lit(""))
            .otherwise(s))


_INT_BOUNDS = {"int": (-2147483648, 2147483647), "bigint": (-9223372036854775808, 9223372036854775807)}


def _text_to_num(text: Column, sql_type: str, other: int | None = 0) -> Column:
    """Loose number read of a JSON string: integer text converts (0 when it
    overflows); any other text is read as a double and truncated toward
    zero, saturating at the type bounds; unreadable text gives ``other``."""
    lo, hi = _INT_BOUNDS[sql_type]
    t = F.trim(text)
    d = t.try_cast("double")
    as_double = (F.when(d.isNull() | F.isnan(d), F.lit(other).cast(sql_type))
                 .when(d >= F.lit(float(hi)), F.lit(hi))
                 .when(d <= F.lit(float(lo)), F.lit(lo))
                 .otherwise(d.cast(sql_type)))
    return (F.when(t.rlike(r"^[+-]?[0-9]+$"), F.coalesce(t.try_cast(sql_type), F.lit(0)))
            .otherwise(as_double).cast(sql_type))


def _num_of(var, field: str, sql_type: str, other: int | None = 0) -> Column:
    var = to_col(var)
    # Common case first: a number (or boolean, or integer text) converts
    # directly; the field is only looked at as a VARIANT when that fails.
    direct = F.try_variant_get(var, path_of(field), sql_type)
    v = node(var, field)
    kind = F.schema_of_variant(v)
    text = F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
    number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return (F.when(direct.isNotNull(), direct)
            .when(v.isNull() | number, F.lit(None).cast(sql_type))
            .when(text.isNotNull(), _text_to_num(text, sql_type, other))
            .otherwise(F.lit(other).cast(sql_type)))


def int_of(var, field: str) -> Column:
    """Loose int read: numbers truncate, numeric text converts (``"7.5"`` ->
    7, ``"1e3"`` -> 1000), booleans give 1/0, anything else 0. NULL when the
    field is missing or a number outside the type's range."""
    return _num_of(var, field, "int")


def long_of(var, field: str, other: int | None = 0) -> Column:
    """As :func:`int_of` for 64-bit values; ``other`` is what a text that is
    no number (or a JSON null, object or array) gives."""
    return _num_of(var, field, "bigint", other)


def decimal_of(var, field: str, precision: int = 38, scale: int = 18) -> Column:
    """Exact decimal read of a number field (no double rounding)."""
    return F.try_variant_get(to_col(var), path_of(field), f"decimal({precision},{scale})")


def trimmed(text) -> Column:
    """The JSON text without surrounding whitespace (compact output form)."""
    return F.trim(to_col(text), F.lit(_JSON_SPACE))


def as_text(value) -> Column:
    """Record value as text; binary values must be valid UTF-8 (else NULL)."""
    return F.try_validate_utf8(to_col(value).cast("string"))


def unwrap(value, field: str = "message") -> tuple[Column, Column]:
    """Shipper-envelope unwrap (Filebeat ``message``, Fluent Bit ``log``).

    Returns ``(ok, inner_text)``: the envelope must parse, carry ``field``,
    and the text of that field must itself be a JSON object or array.
    ``inner_text`` is the payload text, trimmed; it is only meaningful
    where ``ok`` is true. Where fields of the payload are read as well, use
    :func:`with_unwrapped`, which parses it once.
    """
    wrapper = parse(value)
    inner = text_of(wrapper, field)
    return is_container(inner), trimmed(inner)


def with_unwrapped(df, field: str = "message", value: str = "value", more=None):
    """Add ``_inner`` (payload text), ``_ivar`` (parsed payload), ``_inner_ok`` and ``_wrapped`` (the envelope was parsed).

    Staged as separate projections so the envelope and the payload are each
    parsed exactly once, however many fields are read afterwards. ``more``
    gives further columns, by name, for the parsed payload's own projection.
    """
    df = df.withColumn("_wvar", parse(value))
    df = df.withColumns({"_inner": trimmed(text_of("_wvar", field)), "_wrapped": F.col("_wvar").isNotNull()}).drop("_wvar")
    df = df.withColumn("_first", F.try_parse_json("_inner"))
    ivar = or_large("_inner", "_first")
    df = df.withColumns({"_ivar": ivar, **(more(ivar) if more else {})}).drop("_first")
    return df.withColumn("_inner_ok", is_container("_inner", "_ivar"))


def error_record(data, reason: str | Column, detected_at: Column) -> Column:
    """Dead-letter value ``{"detected_at","deserial_error","data"}`` as text.

    ``data`` is the original record text (NULL for a tombstone stays a JSON
    null). ``detected_at`` is an ISO-8601 string with offset, usually
    :func:`logweave.functions.timecols.iso_offset_datetime`.
    """
    reason_col = reason if isinstance(reason, Column) else F.lit(reason)
    return F.to_json(
        F.struct(detected_at.alias("detected_at"), reason_col.alias("deserial_error"),
                 to_col(data).cast("string").alias("data")),
        {"ignoreNullFields": "false"})
