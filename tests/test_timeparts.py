import datetime as dt

from pyspark.sql import functions as F

from peakflow.functions.timestamps import parse_timestamp
from peakflow.operators import timeparts
from peakflow.spec import MovementSpec

CASES = [
    ("2024-01-05 10:30+03:00", 1704439800),
    ("2024-01-05 10:30:15+03:00", 1704439815),
    ("2024-01-05 07:30Z", 1704439800),
    ("2024-01-05 10:30:15+0300", 1704439815),
    ("2024-01-05 10:30+03", 1704439800),
    ("2024-01-05T10:30:15+03:00", 1704439815),
    ("2024-01-05T07:30:15Z", 1704439815),
    ("2024-01-05 10:30:15", 1704439815),  # no offset: wall-clock time in Asia/Riyadh
    ("2024-01-05T10:30:15", 1704439815),
    ("2024-01-05T10:30:15.5+03:00", 1704439815),
    ("2024-01-05T07:30:15+00:00", 1704439815),
    ("2024-1-5 9:30:00", 1704436200),  # unpadded
    ("2024-01-05 9:30", 1704436200),
    ("2024-01-05", 1704402000),  # a date, a month and a year alone
    ("2024-01", 1704056400),
    ("2024", 1704056400),
    ("2024-01-05 10:30:15 UTC", 1704450615),  # a named zone
    ("2024-01-05 10:30:15 Asia/Tokyo", 1704418215),
    ("2024-01-05T10:30:15 America/New_York", 1704468615),
    ("10:30", None),  # a time alone would mean today
    ("T10:30:00", None),
    ("10:30+03:00", None),
    ("10:30Z", None),
    ("garbage", None),
    ("", None),
    (None, None),
]


def test_parse_cases(spark):
    df = spark.createDataFrame(CASES, "s string, want long")
    got = df.select("want", F.unix_seconds(parse_timestamp(F.col("s"))).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_parse_independent_of_session_zone(spark):
    df = spark.createDataFrame(CASES, "s string, want long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Riyadh" if old == "UTC" else "UTC")
        again = df.select(F.unix_seconds(parse_timestamp(F.col("s"))).alias("got")).collect()
        assert [r["got"] for r in again] == [r["want"] for r in df.select("want").collect()]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select("want", F.unix_seconds(parse_timestamp(F.col("s"))).alias("got")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_time_parts(spark):
    spec = MovementSpec(local_time="t")
    df = spark.createDataFrame([("2024-01-05 10:30+03:00",), ("2024-01-06 23:30+03:00",),
                                ("2024-01-07 00:10+03:00",), ("2024-01-06 21:10Z",)], "t string")
    out = timeparts.time_parts(timeparts.parse_timestamps(df, spec), spec).collect()
    got = [(r["scheduled_date_local"], r["hour_of_day"], r["day_of_week"], r["is_weekend"]) for r in out]
    assert got == [(dt.date(2024, 1, 5), 10, 6, 1), (dt.date(2024, 1, 6), 23, 7, 1),
                   (dt.date(2024, 1, 7), 0, 1, 0), (dt.date(2024, 1, 7), 0, 1, 0)]


def test_time_parts_ntz_taken_as_wall_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 10, 30),)], "scheduled_local_ts timestamp_ntz")
    r = timeparts.time_parts(df).collect()[0]
    assert (r["hour_of_day"], r["day_of_week"]) == (10, 6)


def test_filter_unparsed(spark):
    spec = MovementSpec(local_time="t")
    df = spark.createDataFrame([("2024-01-05 10:30+03:00",), ("nope",)], "t string")
    assert timeparts.filter_unparsed(timeparts.parse_timestamps(df, spec)).count() == 1


def test_parse_runs_once_per_row(spark):
    """The unparsable filter must sit above the parse, not re-run it below."""
    spec = MovementSpec(local_time="t")
    df = spark.createDataFrame([("2024-01-05 10:30+03:00",)], "t string")
    plan = timeparts.filter_unparsed(timeparts.parse_timestamps(df, spec))._jdf.queryExecution() \
        .optimizedPlan().toString()
    filter_line = [ln for ln in plan.splitlines() if "Filter" in ln][0]
    assert "gettimestamp" not in filter_line


def test_utc_column(spark):
    spec = MovementSpec(local_time="l", utc_time="u")
    df = spark.createDataFrame([("2024-01-05 10:30+03:00", "2024-01-05 07:30Z"), ("2024-1-5 10:30", "nope")], "l string, u string")
    out = timeparts.parse_timestamps(df, spec).select(F.unix_seconds("scheduled_local_ts"), F.unix_seconds("scheduled_utc_ts")).collect()
    assert [tuple(r) for r in out] == [(1704439800, 1704439800), (1704439800, None)]
