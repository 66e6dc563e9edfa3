import json
import random

import pytest
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.functions import numtext as N

SIXTY = "123456789012345678901234567890123456789012345678901234567.890"
CASES = [
    ('{"n":%s}' % SIXTY, SIXTY), ('{"n":1.50}', "1.50"), ('{"n" : -0.0 , "m":2}', "-0.0"), ('{"n":1E3}', "1E3"),
    ('{"n":1e+400}', "1e+400"), ('{"n":-0}', "-0"), ('{"n":0}', "0"), ('{"n":7}', "7"), ('{"n":-9223372036854775808}', "-9223372036854775808"),
    ('{"n":9223372036854775808}', "9223372036854775808"), ('{"n":100000000000000000000000000000000000000000.00}', "1" + "0" * 41 + ".00"),
    ('{"n":"1.50"}', None), ('{"n":null}', None), ('{"n":true}', None), ('{"n":[1.50]}', None), ('{"n":{"n":1.50}}', None), ('{"m":1.50}', None),
    ('[{"n":1.50}]', None), ('{"m":{"n":1.0},"n":2.50,"k":{"n":3.0}}', "2.50"), ('{"m":[{"n":1.0}],"n":2.50,"k":[[{"n":3.0}]]}', "2.50"),
    ('{"t":"\\"n\\":9.00,{[","n":2.50}', "2.50"), ('{"t":"\\\\","n":2.50}', "2.50"), ('{"t":"\\\\\\"n\\":1.0","n":2.50}', "2.50"),
    ('{"\\u006e":2.50}', "2.50"), ('{"n":1.10,"n":2.50}', "2.50"), ('{"n":2.50} "n":9.00}', "2.50"), ('{"n":2.50}{"n":9.00}', "2.50"),
    ('{"n":2.50} "', "2.50"), ('\t{\n"n"\r:\n2.50\n}', "2.50"), ('{"t":"' + "\\\\\\n" * 50_000 + '","n":2.50}', "2.50"),
    ('{"t":[' + "0.10," * 20_000 + '1],"n":2.50}', "2.50"), ("{}", None), ("[]", None), ("2.50", None), ("", None), ("{", None), (None, None),
]


def read(spark, rows, field):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, t string").withColumn("v", J.parse("t"))
    got = df.select("k", N.number_text("t", "v", field).alias("n")).collect()
    return [r.n for r in sorted(got)]


def test_numbers_as_written(spark):
    assert read(spark, [t for t, _ in CASES], "n") == [n for _, n in CASES]


def test_numbers_below_a_path(spark):
    rows = [('{"a":{"b":1.50},"b":2.50}', "1.50"), ('{"b":2.50,"a":{"x":{"b":3.50},"b":1.50}}', "1.50"), ('{"a":[{"b":1.50}]}', None),
            ('{"a":{"b":1.10},"a":{"b":1.50}}', "1.50"), ('{"a":{"b":1.10},"a":{"c":1.50}}', None), ('{"a":1.50}', None), ('{"x":{"a":{"b":1.50}}}', None)]
    assert read(spark, [t for t, _ in rows], "$.a.b") == [n for _, n in rows]
    with pytest.raises(ValueError):
        N.scalar_text("t", "$.a[0]")


def test_odd_names(spark):
    for name in ('a"b', "a\\b", "a.b", "é", "", "a:b,{"):
        assert read(spark, [json.dumps({name: 0}).replace(": 0}", ": 1.50}")], name) == ["1.50"], name


def test_records_beyond_the_tokens_give_the_parsed_form(spark, monkeypatch):
    monkeypatch.setattr(N, "TOKEN_BYTES", 10)
    assert read(spark, ['{"n":1.50}', '{"n": 1.50}'], "n") == ["1.50", "1.5"]


def test_random_records_against_a_reader_that_keeps_the_text(spark):
    rng = random.Random(5)

    def number():
        return rng.choice(["", "-"]) + rng.choice(["0", str(rng.randrange(1, 10 ** rng.randrange(1, 60)))]) + rng.choice(
            ["", ".0", ".50", ".%09d" % rng.randrange(10 ** 9)]) + rng.choice(["", "", "e5", "E-3", "e+12"])

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 2:
            return number()
        if kind < 4:
            return rng.choice(["null", "true", json.dumps(rng.choice(["n", 'q"n":1', "\\", "}{", "é,", "\\\""]))])
        if kind == 4:
            return "[" + ",".join(value(depth - 1) for _ in range(rng.randrange(4))) + "]"
        return "{" + " , ".join(rng.choice(['"n"', '"m"', '"\\u006e"', '"x\\""']) + ":" + value(depth - 1) for _ in range(rng.randrange(5))) + "}"

    class Text(str):
        """A number's own characters."""

    rows, want = [], []
    for _ in range(400):
        text = '{"m":' + value(3) + ',"n":' + value(3) + ',"k":' + value(3) + "}"
        found = json.loads(text, parse_float=Text, parse_int=Text)["n"]
        rows.append(text)
        want.append(str(found) if isinstance(found, Text) else None)
    assert read(spark, rows, "n") == want


def test_the_plan_has_no_python(spark):
    df = spark.createDataFrame([('{"n":1.50}',)], "t string").withColumn("v", J.parse("t"))
    plan = df.select(N.number_text("t", "v", "n").alias("n"), F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
