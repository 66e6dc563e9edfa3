"""Exact-value tables from the reference's own tests (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.functions import textcols as X
from logweave.functions import timecols as T

# F-A: value, object_or_array, parseable
F_A = [
    ('{"source": "source", "message": "message"}', True, True),
    ('{"sinkAeqwrgqergq":}', False, False),
    ('"JustString"', False, True),
    ('123.45', False, True),
    ('true', False, True),
    ('null', False, True),
    ('"JustString": "source"', False, True),
    ('"JustString":', False, True),
    ('{"NormalKey":"NormalValue"}', True, True),
    ('"{\\"NormalKey\\":\\"NormalValue\\"}"', False, True),
    ('"Broken":"JsonString"', False, True),
    ('"\\"Broken\\":\\"JsonString\\""', False, True),
]


def test_f_a_validity(spark):
    df = spark.createDataFrame(F_A, "v string, want_valid boolean, want_parse boolean")
    got = df.select("v", "want_valid", "want_parse",
                    J.is_valid_json("v").alias("valid"),
                    J.is_parseable_json("v").alias("parse")).collect()
    for r in got:
        assert r.valid == r.want_valid, r.v
        assert r.parse == r.want_parse, r.v


def test_validity_edges(spark):
    rows = [('{"a":1} x', True), ('[]', True), ('{}', True), ("{'a':1}", False),
            ('{"a":NaN}', False), ('', False), (None, False), ('  \n{"a":1}', True),
            ('{"a":1,"a":2}', True)]
    df = spark.createDataFrame(rows, "v string, want boolean")
    for r in df.select("v", "want", J.is_valid_json("v").alias("got")).collect():
        assert r.got == r.want, r.v


def test_text_of_semantics(spark):
    doc = '{"s":"x","n":7,"b":true,"z":null,"o":{"k":1},"a":[1],"t":"{not"}'
    df = spark.createDataFrame([(doc,)], "v string").select(J.parse("v").alias("j"))
    r = df.select(*[J.text_of("j", f).alias(f) for f in ["s", "n", "b", "z", "o", "a", "t", "missing"]]).first()
    assert (r.s, r.n, r.b, r.z, r.o, r.a, r.t, r.missing) == ("x", "7", "true", "null", "", "", "{not", None)


def test_int_of_coercion(spark):
    doc = '{"i":7,"s":"7","t":true,"f":1.9,"x":"abc","z":null,"o":{}}'
    df = spark.createDataFrame([(doc,)], "v string").select(J.parse("v").alias("j"))
    r = df.select(*[J.int_of("j", f).alias(f) for f in ["i", "s", "t", "f", "x", "z", "o", "missing"]]).first()
    assert (r.i, r.s, r.t, r.f, r.x, r.z, r.o, r.missing) == (7, 7, 1, 1, 0, 0, 0, None)


def test_int_of_numeric_text(spark):
    vals = ['"7.5"', '" -12.7 "', '"1e3"', '"+7"', '"99999999999"', '"abc"', '""', '"1e20"', '"NaN"']
    want = [7, -12, 1000, 7, 0, 0, 0, 2147483647, 0]
    df = spark.createDataFrame([('{"v":' + v + '}',) for v in vals], "j string")
    got = [r.i for r in df.select(J.int_of(J.parse("j"), "v").alias("i")).collect()]
    assert got == want
    got_long = [r.i for r in df.select(J.long_of(J.parse("j"), "v").alias("i")).collect()]
    assert got_long[4] == 99999999999 and got_long[7] == 9223372036854775807


def test_decimal_kept_exact(spark):
    df = spark.createDataFrame([('{"d":12345678901234567890.123456789}',)], "v string")
    r = df.select(J.decimal_of(J.parse("v"), "d", 38, 9).cast("string").alias("d")).first()
    assert r.d == "12345678901234567890.123456789"


def test_unwrap_filebeat(spark):
    rows = [('{"message":"{\\"a\\":1}","host":{}}', True, '{"a":1}'),
            ('{"message":"[1,2]"}', True, '[1,2]'),
            ('{"message":"12"}', False, None),
            ('{"message":"{\\"a\\":"}', False, None),
            ('{"other":1}', False, None),
            ('[{"message":"{}"}]', False, None),
            ('{"message":', False, None),
            ('{"message":{"a":1}}', False, None)]
    df = spark.createDataFrame(rows, "v string, ok boolean, inner string")
    ok, inner = J.unwrap("v", "message")
    for r in df.select("v", "ok", "inner", ok.alias("g_ok"), inner.alias("g_inner")).collect():
        assert r.g_ok == r.ok, r.v
        if r.ok:
            assert r.g_inner == r.inner


def test_error_record_layout(spark):
    df = spark.createDataFrame([("bad", "2024-01-01T00:00:07.1795Z")], "d string, t string")
    r = df.select(J.error_record("d", J.INVALID_JSON, F.col("t")).alias("e")).first()
    assert r.e == '{"detected_at":"2024-01-01T00:00:07.1795Z","deserial_error":"Invalid JSON format","data":"bad"}'
    df = spark.createDataFrame([(None, "x")], "d string, t string")
    assert df.select(J.error_record("d", "r", F.col("t")).alias("e")).first().e.endswith('"data":null}')


# F-B: ISO offset date-time -> datetime(6)
F_B = [
    ("2026-01-13T02:29:56.70212899+00:00", "2026-01-13 02:29:56.702128"),
    ("2026-01-13T02:29:56.70212844+00:00", "2026-01-13 02:29:56.702128"),
    ("2026-01-13T02:29:56.702+00:00", "2026-01-13 02:29:56.702000"),
    ("2026-01-13T02:29:56.7020000+00:00", "2026-01-13 02:29:56.702000"),
    ("2026-01-13T02:29:56.7020000Z", "2026-01-13 02:29:56.702000"),
    ("2026-01-13T02:29:56.7020000+09:00", "2026-01-13 02:29:56.702000"),
    ("2026-01-13T02:29:56.7020000+0000", None),
    ("2026-02-30T02:29:56.7020000+09:00", None),
    ("not a date", None),
    ("2026-01-13T02:29+09:00", "2026-01-13 02:29:00.000000"),
]


def test_f_b_mysql_datetime6(spark):
    df = spark.createDataFrame(F_B, "i string, want string")
    for r in df.select("i", "want", T.mysql_datetime6("i").alias("got")).collect():
        assert r.got == r.want, r.i


def test_f_b_compact(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:00.1234567+0900",), ("2025-01-01T00:00:00.1234567+09:00",)], "i string")
    got = [r.g for r in df.select(T.mysql_datetime6_compact("i").alias("g")).collect()]
    assert got == ["2025-01-01 00:00:00.123456", None]


def test_reformat_datetime(spark):
    df = spark.createDataFrame([("2025-01-01T23:30:00.1234567+09:00",), ("junk",)], "i string")
    got = [r.g for r in df.select(T.reformat_datetime("i", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSXXX",
                                                      "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("g")).collect()]
    assert got == ["2025-01-01 23:30:00.123456", None]


@pytest.mark.parametrize("tz", ["UTC", "Asia/Seoul", "America/New_York"])
def test_f_c_year_month_any_session_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame([(1727352009,), (1727708399,), (1727708400,)], "t long")
        got = [r.g for r in df.select(T.year_month("t").alias("g")).collect()]
        assert got == ["2024_09", "2024_09", "2024_10"]
        ts = spark.createDataFrame([(1704067207,)], "t long").select(F.timestamp_seconds("t").alias("ts"))
        assert ts.select(T.iso_offset_datetime("ts").alias("d")).first().d == "2024-01-01T09:00:07+09:00"
        assert ts.select(T.iso_offset_datetime("ts", "UTC").alias("d")).first().d == "2024-01-01T00:00:07Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_date_suffix(spark):
    df = spark.createDataFrame([("2024-03-05 10:11:12",), ("2024/03/05",), ("2024-02-30 00:00:00",)], "d string")
    assert [r.g for r in df.select(T.date_suffix("d").alias("g")).collect()] == ["_20240305", None, None]


def test_f_d_sha256(spark):
    df = spark.createDataFrame([("12345",)], "v string")
    assert df.select(X.sha256_hex("v").alias("h")).first().h == \
        "5994471abb01112afcc18159f6cc74b4f511b99806da59b3caf5a9c173cacfc5"


def test_f_e_mask_pii(spark):
    msg = ("010-1234-3699과031-1566-3003는 전화번호이고, 1234-6047-1234-9879은 카드번호이고, "
           "999999-1234565은 주민번호다.")
    want = ("**MASKED_PHONE_NUM**과**MASKED_PHONE_NUM**는 전화번호이고, **MASKED_CREDIT_CARD_NUM**은 "
            "카드번호이고, **MASKED_RRN**은 주민번호다.")
    df = spark.createDataFrame([(msg,)], "m string")
    assert df.select(X.mask_pii("m").alias("g")).first().g == want


def test_split_fields_drops_trailing_empties(spark):
    rows = [("a|b||", 2), ("a||b", 3), ("|a", 2), ("", 1), ("||", 0)]
    df = spark.createDataFrame(rows, "m string, n int")
    for r in df.select("m", "n", F.size(X.split_fields("m")).alias("g")).collect():
        assert r.g == r.n, r.m
    assert df.select(X.field_at("m", 8).alias("f")).where("f is not null").count() == 0


CLOCK_PATTERNS = ["yyyy-MM-dd HH:mm:ss.SSS", "EEE, d MMM yyyy h:mm a", "EEEE dd MMMM yy", "D DDD", "Q QQ QQQ QQQQ", "K KK k kk h hh H",
                  "M/d/y m:s", "LLL LLLL L LL", "F", "G GGGG", "yyyyy", "'day' D 'o''clock' h a", "yyyyMMdd[ HH]", "S SSSSSSSSS"]


def test_clock_format_reads_no_session_zone(spark):
    from logweave.functions import timecols

    clocks = ["2024-03-10 02:30:15.123456", "2024-01-01 00:00:00", "2023-12-31 23:59:59.5", "2024-12-31 12:00:00", "2000-02-29 13:05:09.000001",
              "0001-01-01 00:00:00", "9999-12-31 11:59:59.999999", "2021-10-31 01:30:00", None]
    df = spark.createDataFrame([(c,) for c in clocks], "c string").select(F.col("c").cast("timestamp_ntz").alias("c"))
    before, got = spark.conf.get("spark.sql.session.timeZone"), {}
    try:
        for zone in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got[zone] = [tuple(r) for r in df.select(*[timecols.clock_format("c", p).alias(f"p{i}") for i, p in enumerate(CLOCK_PATTERNS)]).collect()]
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        want = [tuple(r) for r in df.select(*[F.date_format("c", p).alias(f"p{i}") for i, p in enumerate(CLOCK_PATTERNS)]).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got["UTC"] == got["America/New_York"] == got["Asia/Seoul"] == want
    for pattern in ("HH:mm X", "VV", "z", "{yyyy}", "aaaaaa", "EEEEEE"):
        with pytest.raises(ValueError):
            timecols.clock_format("c", pattern)


def test_clock_format_weeks(spark):
    """Weeks from Sunday to Saturday; a week belongs to the year of its Saturday. Worked out by hand."""
    from logweave.functions import timecols

    weeks = {"2024-01-01": "2024 1 01 1 2", "2023-12-31": "2024 1 01 6 1", "2022-12-31": "2022 53 53 5 7", "2023-01-01": "2023 1 01 1 1",
             "2024-12-29": "2025 1 01 5 1", "2024-12-28": "2024 52 52 4 7", "2024-02-29": "2024 9 09 5 5"}
    df = spark.createDataFrame([(d + " 05:00:00",) for d in weeks], "c string").select(F.col("c").cast("timestamp_ntz").alias("c"))
    assert [r[0] for r in df.select(timecols.clock_format("c", "YYYY w ww W e")).collect()] == list(weeks.values())


def test_reformat_with_day_names_in_a_skipped_hour(spark):
    from logweave.functions import timecols

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("2024-03-10T02:30:00-05:00",), ("2024-03-31T02:30:00+01:00",), ("no time",)], "t string")
            out = timecols.reformat_datetime("t", "yyyy-MM-dd'T'HH:mm:ssXXX", "EEE d MMM yyyy h:mm a")
            assert [r[0] for r in df.select(out).collect()] == ["Sun 10 Mar 2024 2:30 AM", "Sun 31 Mar 2024 2:30 AM", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_reformat_reads_each_record_once(spark):
    """All fields of the output share one parse of the text; inside a condition each would repeat it."""
    rows = [("2024-02-03T04:05:06.1234567+09:00",), ("2024-02-03T04:05:06.1234567-0930",), ("2024-02-30T04:05:06.1234567+09:00",),
            ("2024-02-03T04:05:06.1234567Z",), ("2024-02-03T04:05:06.1234567+09:30:15",), ("",), ("+09:00",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS"
    from logweave.functions import timecols

    for offset, want in (("XXX", [1, 0, 0, 1, 0, 0, 0, 0]), ("XX", [0, 1, 0, 1, 0, 0, 0, 0]), ("XXXXX", [1, 0, 0, 1, 1, 0, 0, 0])):
        out = timecols.reformat_datetime("t", pattern + offset, "yyyy/MM/dd HH:mm:ss")
        assert [r.g for r in df.select(out.alias("g")).collect()] == ["2024/02/03 04:05:06" if w else None for w in want]
        constant = timecols.reformat_datetime("t", pattern + offset, "'x'")
        assert [r.g for r in df.select(constant.alias("g")).collect()] == ["x" if w else None for w in want]
        plan = df.select(out.alias("g"))._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "gettimestamp" in plan
        assert not [c for c in plan.split("case when ")[1:] if "gettimestamp" in c.split(" then ")[0]]
