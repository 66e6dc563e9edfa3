import datetime as dt

from logweave.sources.records import RECORD_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 7, 179575, tzinfo=dt.timezone.utc)


def records(spark, rows, topic="test-app"):
    """rows: list of (key, value) or (topic, key, value)."""
    out = []
    for i, r in enumerate(rows):
        t, k, v = (topic, *r) if len(r) == 2 else r
        out.append((t, k, v, 0, i, T0))
    return spark.createDataFrame(out, RECORD_SCHEMA)


def collect(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
