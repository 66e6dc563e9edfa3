"""Date/time column functions for topic names and database payloads.

None of these read the session time zone for their result: every zone is
an explicit argument, and instants become wall-clock values by adding their
microseconds to a zone-less epoch and converting that from UTC, so the same
job gives the same topics on any cluster setting, repeated hours included.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.common import to_col

DEFAULT_ZONE = "Asia/Seoul"

# ISO-8601 date-time with offset: date, 'T', HH:mm[:ss[.fraction]], offset
# 'Z' | +HH | +HH:MM | +HH:MM:ss, up to 18 hours (the lenient ISO offset date-time form).
_ISO_OFFSET_RE = (r"^(\d{4}-\d{2}-\d{2})[Tt](\d{2}:\d{2})(?::(\d{2})(?:\.(\d{0,9}))?)?"
                  r"(?:[Zz]|[+-](?:(?:0\d|1[0-7])(?::[0-5]\d(?::[0-5]\d)?)?|18(?::00(?::00)?)?))\z")
# Compact form with exactly seven fraction digits and a +HHMM offset.
_COMPACT_RE = r"^(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})\.(\d{7})([+-](?:(?:0\d|1[0-7])[0-5]\d|1800))\z"
_LOCAL_RE = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})\z"
# An offset at the end of a text, and the pattern letters that stand for one.
_OFFSET_RE = r"(?:[Zz]|[+-]\d{2}(?::?\d{2})?(?::?\d{2})?)\z"
_OFFSET_LETTERS = "XxZOVz"
# Seconds of 0001-01-01 and of 9999-12-31T23:59:59 UTC.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def wall_clock(ts, zone: str = DEFAULT_ZONE) -> Column:
    """Instant (TIMESTAMP) -> wall-clock TIMESTAMP_NTZ in ``zone``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("MICROSECOND", F.unix_micros(to_col(ts)), epoch))


_PARTS = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}
# Names in the order of the calendar, weeks from Sunday.
_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
           "November", "December"]
_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_QUARTERS = ["1st quarter", "2nd quarter", "3rd quarter", "4th quarter"]


def _named(number: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), number)


def _clock_field(token: str, text: Column) -> Column:
    """One run of a pattern letter, rendered from a clock's text ``yyyy-MM-dd HH:mm:ss[.S]``; weeks begin on Sunday."""
    letter, width = token[0], len(token)
    date = F.substring(text, 1, 10).cast("date")
    hour = F.substring(text, 12, 2).cast("int")
    month, weekday = F.month(date), F.dayofweek(date)
    week_end = F.date_add(date, 7 - weekday)  # the year that holds a week's Saturday holds the week
    first_weekday = F.dayofweek(F.trunc(date, "year"))

    if letter in "ML" and width in (3, 4):
        return _named(month, [m[:3] if width == 3 else m for m in _MONTHS])
    if letter == "E" and width <= 4:
        return _named(weekday, [d[:3] if width < 4 else d for d in _DAYS])
    if letter in "Qq" and width in (3, 4):
        return _named(F.quarter(date), ["Q" + q[0] if width == 3 else q for q in _QUARTERS])
    if letter == "a" and width == 1:
        return F.when(hour < 12, "AM").otherwise("PM")
    if letter == "G" and width <= 4:
        return F.lit("AD" if width < 4 else "Anno Domini")
    if letter == "S" and width <= 9:
        return F.rpad(F.substring(text, 21, width), width, "0")

    # letter: number, the most letters it takes
    numbers = {
        "y": (F.year(date), 6), "u": (F.year(date), 6), "Y": (F.year(week_end), 6),
        "M": (month, 2), "L": (month, 2), "d": (F.dayofmonth(date), 2), "D": (F.dayofyear(date), 3),
        "Q": (F.quarter(date), 2), "q": (F.quarter(date), 2), "F": ((F.dayofmonth(date) - 1) % 7 + 1, 1),
        "e": (weekday, 2), "c": (weekday, 1),
        "w": (F.when(F.year(week_end) > F.year(date), 1).otherwise(
            F.ceil((F.dayofyear(date) + first_weekday - 1) / 7)), 2),
        "W": (F.ceil((F.dayofmonth(date) + F.dayofweek(F.trunc(date, "month")) - 1) / 7), 1),
        "H": (hour, 2), "k": (F.when(hour == 0, 24).otherwise(hour), 2), "K": (hour % 12, 2),
        "h": ((hour + 11) % 12 + 1, 2), "m": (F.substring(text, 15, 2).cast("int"), 2),
        "s": (F.substring(text, 18, 2).cast("int"), 2)}
    number, most = numbers.get(letter, (None, 0))
    if width > most:
        raise ValueError(f"a clock without a zone has no field {token!r}")
    if letter in "yuY" and width == 2:
        number = number % 100
    number = number.cast("string")
    return F.lpad(number, F.greatest(F.length(number), F.lit(width)), F.lit("0")) if width > 1 else number


def clock_format(local, pattern: str) -> Column:
    """A wall-clock TIMESTAMP_NTZ (years 1 to 9999) as text, by a date-time pattern.

    ``date_format`` would read the clock in the session zone, which has no
    02:30 on the day its clocks go forward; here all letters are rendered from
    the clock's own text, in English, with weeks that begin on Sunday. Letters
    of a zone or an offset, and letters that no clock has, are a ``ValueError``.
    ``[`` and ``]`` are passed over, as all fields of a clock are there.
    """
    text = to_col(local).cast("string")
    out = []
    for token in re.finditer(r"'((?:[^']|'')*)'|([a-zA-Z])\2*|[^a-zA-Z'\[\]]+", pattern):
        t = token.group()
        if t[0] == "'":  # quoted text; two quotes are one
            out.append(F.lit(token.group(1).replace("''", "'") or "'"))
        elif t in _PARTS:
            out.append(F.substring(text, *_PARTS[t]))
        elif t[0].isalpha():
            out.append(_clock_field(t, text))
        elif set(t) & set("#{}"):
            raise ValueError(f"reserved characters in the pattern {pattern!r}")
        else:
            out.append(F.lit(t))
    if not any(p in pattern for p in _PARTS):
        out.append(F.when(text.isNotNull(), ""))  # constants alone would give a text for no clock
    return F.concat(*out)


def iso_offset_datetime(ts, zone: str = DEFAULT_ZONE) -> Column:
    """Instant -> ``yyyy-MM-ddTHH:mm:ss[.fraction]+HH:MM`` in ``zone``.

    Same text as the standard ISO offset date-time formatter: the fraction
    drops trailing zeros (and the dot when zero), a zero offset prints 'Z'.
    """
    local = wall_clock(ts, zone)
    utc = wall_clock(ts, "UTC")
    off = F.timestamp_diff("SECOND", utc, local)
    a = F.abs(off)
    hhmm = F.concat(F.lpad((a / 3600).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(((a % 3600) / 60).cast("int").cast("string"), 2, "0"))
    offset = F.when(off == 0, F.lit("Z")).otherwise(
        F.concat(F.when(off < 0, F.lit("-")).otherwise(F.lit("+")), hhmm))
    frac = F.rtrim(clock_format(local, "SSSSSS"), F.lit("0"))
    return F.concat(clock_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
                    offset)


def now_iso(zone: str = DEFAULT_ZONE) -> Column:
    """Processing-time detection stamp (one value per micro-batch/query)."""
    return iso_offset_datetime(F.current_timestamp(), zone)


def date_suffix(text, prefix: str = "_") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``_yyyyMMdd``; NULL when not a real date-time."""
    t = to_col(text)
    ok = t.rlike(_LOCAL_RE) & F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    # shape checked by the regex: the parts sit at fixed positions
    return F.when(ok, F.concat(F.lit(prefix), F.substring(t, 1, 4), F.substring(t, 6, 2), F.substring(t, 9, 2)))


def _calendar_ok(date: Column, hms: Column) -> Column:
    return F.try_to_timestamp(F.concat(date, F.lit(" "), hms), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()


def mysql_datetime6(text) -> Column:
    """ISO offset date-time -> MySQL ``datetime(6)`` text, wall clock kept.

    The offset is dropped (not applied), the fraction is truncated or
    zero-padded to six digits. ``+09:00`` and ``Z`` are accepted, the
    compact ``+0900`` is not. NULL on any failure.

    One regex checks the shape; after that date and clock sit at fixed
    positions and the fraction runs up to the offset sign, so the pieces
    are cut with plain substrings, and one parse checks the calendar.
    """
    t = to_col(text)
    has_ss = F.substring(t, 17, 1) == ":"
    ss = F.when(has_ss, F.substring(t, 18, 2)).otherwise(F.lit("00"))
    tail = F.substring(t, 21, 64)
    cut = F.least(*[F.when(F.instr(tail, c) > 0, F.instr(tail, c)) for c in ("Z", "z", "+", "-")])
    frac = F.when(has_ss & (F.substring(t, 20, 1) == "."), F.substring(tail, F.lit(1), cut - 1)).otherwise(F.lit(""))
    out = F.concat(F.substring(t, 1, 10), F.lit(" "), F.substring(t, 12, 5), F.lit(":"), ss, F.lit("."),
                   F.rpad(F.substring(frac, 1, 6), 6, "0"))
    ok = t.rlike(_ISO_OFFSET_RE) & F.try_to_timestamp(out, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).isNotNull()
    return F.when(ok, out)


def mysql_datetime6_compact(text) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSSSSS+HHMM`` -> ``datetime(6)``, truncating."""
    t = to_col(text)
    date = F.regexp_extract(t, _COMPACT_RE, 1)
    hms = F.regexp_extract(t, _COMPACT_RE, 2)
    frac = F.regexp_extract(t, _COMPACT_RE, 3)
    out = F.concat(date, F.lit(" "), hms, F.lit("."), F.substring(frac, 1, 6))
    return F.when(t.rlike(_COMPACT_RE) & _calendar_ok(date, hms), out)


def reformat_datetime(text, in_pattern: str, out_pattern: str) -> Column:
    """Generic offset date-time reformat keeping the written wall clock.

    ``in_pattern``/``out_pattern`` use Spark datetime patterns. The text is
    parsed to an instant with its own offset, then shifted back by that
    offset so the output shows the clock time that was written; fractions
    beyond microseconds are truncated. NULL when the text does not parse.
    """
    t = to_col(text)
    if any(c in _OFFSET_LETTERS for c in _unquoted(in_pattern)):
        instant = F.try_to_timestamp(t, F.lit(in_pattern))
        # one search; without its colons an offset's sign and numbers sit at fixed positions
        offset = F.translate(F.regexp_extract(t, _OFFSET_RE, 0), ":", "")
        number = [F.coalesce(F.substring(offset, at, 2).try_cast("int"), F.lit(0)) for at in (2, 4, 6)]
        secs = F.when(F.substring(offset, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1)) * (
            number[0] * 3600 + number[1] * 60 + number[2])
    else:  # no offset in the pattern: the written clock is read as UTC and stays as it is
        instant, secs = F.try_to_timestamp(F.concat(t, F.lit("Z")), F.lit(in_pattern + "X")), F.lit(0)
    local = F.timestamp_add("SECOND", secs, wall_clock(instant, "UTC"))
    # no condition around the fields: a clock that is null gives null, and what all fields share (the
    # parse, the clock's text) is computed once for a row, which Spark does not do inside a condition
    return clock_format(local, out_pattern)


def _unquoted(pattern: str) -> str:
    return "".join(pattern.split("'")[::2])


def year_month(epoch_seconds, zone: str = DEFAULT_ZONE, pattern: str = "yyyy_MM") -> Column:
    """Epoch seconds -> ``yyyy_MM`` in ``zone`` (default Asia/Seoul); NULL outside the years 1 to 9999."""
    secs = to_col(epoch_seconds)
    ts = F.timestamp_seconds(F.when(secs.between(_FIRST_SECOND + 86400, _LAST_SECOND - 86400), secs))
    return clock_format(wall_clock(ts, zone), pattern)
