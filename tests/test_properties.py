"""Property checks against small Python models, one Spark batch per test."""

import datetime as dt
import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logweave.functions import jsoncols as J
from logweave.functions import textcols as X
from logweave.functions import timecols as T

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10**12, 10**12) | st.text(max_size=8),
    lambda kids: st.lists(kids, max_size=4) | st.dictionaries(st.text(max_size=5), kids, max_size=4),
    max_leaves=12)


def _model_valid(s):
    """Object or array as the first JSON value; trailing text ignored."""
    if s is None:
        return False
    t = s.lstrip(" \t\n\r")
    try:
        v, _ = json.JSONDecoder(parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c))).raw_decode(t)
    except ValueError:
        return False
    return isinstance(v, (dict, list))


def _mutate(s, i):
    k = i % 5
    if k == 0:
        return s[: len(s) // 2]
    if k == 1:
        return "  " + s + " trailing"
    if k == 2:
        return s.replace('"', "'")
    if k == 3:
        return s + "}"
    return s


@SETTINGS
@given(st.lists(json_values, min_size=40, max_size=80))
def test_validity_matches_model(spark, values):
    texts = []
    for i, v in enumerate(values):
        s = json.dumps(v, separators=(",", ":"), ensure_ascii=bool(i % 2))
        texts += [s, _mutate(s, i)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.ok for r in df.select(J.is_valid_json("v").alias("ok")).collect()]
    want = [_model_valid(t) for t in texts]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:5]


def _java_split(s, sep="|"):
    parts = s.split(sep)
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab|", max_size=12), min_size=30, max_size=60))
def test_split_matches_jvm_split(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    got = [list(r.f) for r in df.select(X.split_fields("m").alias("f")).collect()]
    assert got == [_java_split(t) for t in texts]


def _model_datetime6(s):
    m = re.fullmatch(r"(\d{4}-\d{2}-\d{2})[Tt](\d{2}):(\d{2})(?::(\d{2})(?:\.(\d{0,9}))?)?"
                     r"(?:[Zz]|[+-]\d{2}(?::\d{2}(?::\d{2})?)?)", s)
    if not m:
        return None
    date, hh, mm, ss, frac = m.groups()
    ss = ss or "00"
    try:
        dt.datetime.strptime(f"{date} {hh}:{mm}:{ss}", "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None
    return f"{date} {hh}:{mm}:{ss}.{((frac or '')[:6]).ljust(6, '0')}"


parts = st.tuples(
    st.integers(1, 9999), st.integers(0, 13), st.integers(0, 32), st.integers(0, 24), st.integers(0, 60),
    st.one_of(st.none(), st.integers(0, 60)), st.one_of(st.none(), st.text(alphabet="0123456789", max_size=10)),
    st.sampled_from(["Z", "z", "+09:00", "-05:30", "+0900", "+09", "+09:00:00", "", "UTC"]),
    st.sampled_from(["T", "t", " "]))


def _render(p):
    y, mo, d, h, mi, s, frac, off, sep = p
    out = f"{y:04d}-{mo:02d}-{d:02d}{sep}{h:02d}:{mi:02d}"
    if s is not None:
        out += f":{s:02d}"
        if frac is not None:
            out += "." + frac
    return out + off


@SETTINGS
@given(st.lists(parts, min_size=40, max_size=80))
def test_datetime6_matches_model(spark, ps):
    texts = [_render(p) for p in ps]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.d for r in df.select(T.mysql_datetime6("v").alias("d")).collect()]
    want = [_model_datetime6(t) for t in texts]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:5]
