"""The text of a number as it stands in a JSON record.

A parsed record keeps a number's value: ``1.50`` comes back as ``1.5``,
``1E3`` as ``1000.0``, and beyond 38 digits a double is all that is left.
:func:`number_text` reads the number's own characters instead, so ledgers
and checksums over them survive byte for byte.

The text is cut into tokens by one pattern without nested repetition (a
string is one token, whatever its length) and folded once, keeping the depth
and how much of the path is matched. Escaped quotes are replaced before by
control characters, which no valid JSON text holds, and put back in the
tokens that are read. Where the name stands in the record once only, and
nothing is escaped, one pattern finds the number without the fold. All of it
is built-in expressions.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.common import to_col
from logweave.functions.jsoncols import node

#: Bytes of a record whose tokens are held at once; numbers of a longer record are read from the parsed value.
TOKEN_BYTES = 4_000_000
#: Stand for an escaped backslash and an escaped quote.
_BACKSLASH, _QUOTE = "\x01\x02", "\x01\x03"
_TOKENS = r'"[^"]*+"|[^"{}\[\],:\s]++|[{}\[\],:]'


def _names(field: str) -> list[str]:
    if not field.startswith("$."):
        return [field]
    if "[" in field:
        raise ValueError(f"only member names are read here: {field}")
    return field[2:].split(".")


def _original(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _is_name(token: Column, name: str) -> Column:
    """Whether a string token spells a member name, by escapes or without."""
    plain = F.lit(f'"{name}"') == token if not set(name) & set('"\\') else F.lit(False)
    spelled = F.get_json_object(F.concat(F.lit("["), _original(token), F.lit("]")), "$[0]") == name
    return F.when(token.contains("\\") | token.contains("\x01"), F.coalesce(spelled, F.lit(False))).otherwise(plain)


def scalar_text(text, field: str) -> Column:
    """Characters of a scalar field of a *valid* JSON object, strings with their quotes and escapes.

    NULL where the field is missing, or is an object or array. Of a repeated
    key the last value counts. ``field`` is a name, or a path ``$.a.b``.
    """
    names = _names(field)
    masked = F.replace(F.replace(to_col(text), F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    none = F.lit(None).cast("string")

    def state(depth, matched, last, wanted, found):
        return F.struct(depth.alias("depth"), matched.alias("matched"), last.alias("last"), wanted.alias("wanted"), found.alias("found"))

    # depth: open brackets, -1 after the record; matched: open objects on the path; last: the string before a colon;
    # wanted: the coming value is the path's next
    start = state(F.lit(0), F.lit(0), none, F.lit(False), none)

    def step(s, t):
        here = s["depth"] == s["matched"]
        named = F.coalesce(here & reduce(or_, [(s["matched"] == k) & _is_name(s["last"], n) for k, n in enumerate(names, 1)]), F.lit(False))
        opens = here & ((s["depth"] == 0) | (s["wanted"] & (s["matched"] < len(names))))
        shut = s["depth"] - 1
        return (F.when(s["depth"] < 0, s)
                .when(t == "{", state(s["depth"] + 1, s["matched"] + opens.cast("int"), none, F.lit(False), s["found"]))
                .when(t == "[", state(s["depth"] + 1, s["matched"], none, F.lit(False), s["found"]))
                .when(t.isin("}", "]"), state(F.when(shut == 0, F.lit(-1)).otherwise(shut), s["matched"] - here.cast("int"), none,
                                              F.lit(False), s["found"]))
                .when(t == ":", state(s["depth"], s["matched"], none, named, F.when(named, none).otherwise(s["found"])))
                .when(t == ",", state(s["depth"], s["matched"], none, F.lit(False), s["found"]))
                .otherwise(state(s["depth"], s["matched"], t, F.lit(False),
                                 F.when(s["wanted"] & here & (s["matched"] == len(names)), _original(t)).otherwise(s["found"]))))

    return F.aggregate(F.regexp_extract_all(masked, F.lit(_TOKENS), F.lit(0)), start, step, lambda s: s["found"])


def number_text(text, var, field: str) -> Column:
    """A number field exactly as it is written in ``text``, whose parsed form is ``var``.

    NULL where the field is missing or no number (a JSON null, a text that
    holds digits). Plain integers are read from the parsed value, which has
    the same characters; so are the numbers of a record beyond
    ``TOKEN_BYTES``, where a decimal has the parsed value's form.
    """
    text, v = to_col(text), node(var, field)
    kind = F.schema_of_variant(v)
    value = F.try_variant_get(v, "$", "string")
    name = _names(field)[-1]
    # between two strings there is a comma or colon at least, so a quoted identifier before a colon is a name
    once, found = F.lit(False), F.lit("")
    if name.isascii() and name.isidentifier():
        once = ~text.contains("\\") & (F.regexp_count(text, F.lit(f'"{name}"\\s*+:')) == 1)
        found = F.regexp_extract(text, f'"{name}"\\s*+:\\s*+(-?[0-9][0-9.eE+-]*+)', 1)
    parsed = ((kind == "BIGINT") & (value != "0")) | (F.octet_length(text) > TOKEN_BYTES)
    return (F.when(F.coalesce(~kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(True)), F.lit(None).cast("string"))
            .when(parsed, value)
            .when(once, found)
            .otherwise(F.coalesce(scalar_text(text, field), value)))
