from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from zoneinfo import ZoneInfo

from factloom.operators.timestamps import _intervals_of, instants_found, resolve_instants, utc_text
from pyspark.sql import functions as F

SOURCES = [("HKF", "Asia/Hong_Kong", True), ("NYC", "America/New_York", False), ("LDN", "Europe/London", True), ("SHD", "Asia/Shanghai", False), ("UTC", "Etc/UTC", False)]

CASES = [
    ("2022-01-01", "NYC", "2021-12-31T16:00:00.000000Z"),
    ("20220101", "LDN", "2021-12-31T16:00:00.000000Z"),
    ("05/01/2022 09:11:02", "HKF", "2022-01-05T01:11:02.000000Z"),
    ("05/01/2022 09:11:02", "NYC", "2022-05-01T13:11:02.000000Z"),
    ("31/12/21", "HKF", "2021-12-30T16:00:00.000000Z"),
    ("1638129634", "UTC", "2021-11-28T20:00:34.000000Z"),
    ("1701187200000", "LDN", "2023-11-28T16:00:00.000000Z"),
    ("1640979335000000", "HKF", "2021-12-31T19:35:35.000000Z"),
    ("44562", "NYC", "2021-12-31T16:00:00.000000Z"),
    ("44562.5", "UTC", "2022-01-01T12:00:00.000000Z"),
    ("20220701045046", "SHD", "2022-06-30T20:50:46.000000Z"),
    ("2022年1月1日", "HKF", "2021-12-31T16:00:00.000000Z"),
    ("2023年1月1日 上午12時00分", "UTC", "2023-01-01T00:00:00.000000Z"),
    ("2023年1月1日 下午2時41分", "UTC", "2023-01-01T14:41:00.000000Z"),
    ("二零二二年十二月三十一日", "HKF", "2022-12-30T16:00:00.000000Z"),
    ("二〇二四年十月二十日", "HKF", "2024-10-19T16:00:00.000000Z"),
    ("２０２２－０７－３１", "LDN", "2022-07-30T16:00:00.000000Z"),
    (" 2020-07-01 ", "SHD", "2020-06-30T16:00:00.000000Z"),
    ("2022-06-30T16:00:00.000Z", "NYC", "2022-06-30T16:00:00.000000Z"),
    ("2021-11-29T20:36:35+08", "LDN", "2021-11-29T12:36:35.000000Z"),
    ("2022-12-31T21:45:00.000000 +05:45", "SHD", "2022-12-31T16:00:00.000000Z"),
    ("2021-04-30T17:00:00[Europe/London]", "HKF", "2021-04-30T16:00:00.000000Z"),
    ("2021-12-31T19:17:38 America/New_York", "HKF", "2022-01-01T00:17:38.000000Z"),
    ("1 Jan 2022 00:00 HKT", "NYC", "2021-12-31T16:00:00.000000Z"),
    ("31 Dec 2022 11:00 EST", "HKF", "2022-12-31T16:00:00.000000Z"),
    ("January 1, 2022 12:00 AM", "UTC", "2022-01-01T00:00:00.000000Z"),
    ("July 1, 2022 12:03 PM", "UTC", "2022-07-01T12:03:00.000000Z"),
    ("3-JUL-2023", "NYC", "2023-07-02T16:00:00.000000Z"),
    ("01-Jan-24", "SHD", "2023-12-31T16:00:00.000000Z"),
    ("2022-01-01 11:08:12,696093", "UTC", "2022-01-01T11:08:12.696093Z"),
    ("202401311530", "UTC", "2024-01-31T15:30:00.000000Z"), ("20240131T1530", "HKF", "2024-01-31T07:30:00.000000Z"), ("20240131T1530+09:00", "HKF", "2024-01-31T06:30:00.000000Z"), ("20240131T153045123Z", "HKF", "2024-01-31T15:30:45.123000Z"),
    # before and after the years of the table's rules
    ("1900-01-02 00:00:00", "HKF", "1900-01-01T16:23:18.000000Z"), ("1650-05-01T12:00:00Z", "HKF", "1650-05-01T12:00:00.000000Z"), ("1650-05-01 12:00:00", "LDN", "1650-05-01T12:01:15.000000Z"),
    ("2150-07-01 12:00:00", "LDN", "2150-07-01T11:00:00.000000Z"), ("2150-01-01 12:00:00", "NYC", "2150-01-01T17:00:00.000000Z"), ("3021-07-01 12:00:00", "LDN", "3021-07-01T11:00:00.000000Z"), ("9999-12-31", "HKF", "9999-12-30T16:00:00.000000Z"),
    # a summer time of seven days
    ("2040-10-25 12:00:00 Asia/Gaza", "HKF", "2040-10-25T09:00:00.000000Z") if ZoneInfo("Asia/Gaza").utcoffset(datetime(2040, 10, 25, 12)) == timedelta(hours=3) else ("2040-10-25 12:00:00 Asia/Gaza", "HKF", "2040-10-25T10:00:00.000000Z"),
    ("2022-07-01 12:00:00 europe/london", "HKF", "2022-07-01T11:00:00.000000Z"), ("2022-07-01 12:00:00 No/Where", "HKF", None), ("2024", "HKF", None), ("123456", "HKF", None),
    # twice on the clock: the first one; skipped: the offset before the change
    ("2022-11-06 01:30:00", "NYC", "2022-11-06T05:30:00.000000Z"),
    ("2022-10-30 01:30:00", "LDN", "2022-10-30T00:30:00.000000Z"),
    ("2022-03-13 02:30:00", "NYC", "2022-03-13T07:30:00.000000Z"),
    ("2022-03-27 01:30:00", "LDN", "2022-03-27T01:30:00.000000Z"),
    # no date
    ("31/02/2024", "HKF", None), ("13/13/2022", "NYC", None), ("n/a", "HKF", None), ("", "HKF", None), ("  ", "HKF", None), (None, "HKF", None), ("年報", "HKF", None),
    ("0000-00-00", "HKF", None), ("2022-01-01 25:00:00", "UTC", None), ("2022-01-01 10:00:00 XYZ", "UTC", None), ("2022-01-01 10:00", "nobody", None), ("x" * 100_000, "HKF", None),
]


def _found(spark, values, **extra):
    rows = [(i, s, v, None) for i, (v, s) in enumerate(values)]
    flat = spark.createDataFrame(rows, "row_id long, source_code string, startdate string, reportdate string")
    for name, value in extra.items():
        flat = flat.withColumn(name, F.lit(value))
    sources = spark.createDataFrame(SOURCES, "source_code string, zone_name string, day_first boolean")
    return {r.row_id: r.utc_text for r in instants_found(flat, sources).collect()}


def test_notations(spark):
    got = _found(spark, [(v, s) for v, s, _ in CASES])
    assert {i: t for i, (_, _, t) in enumerate(CASES) if t} == got


def test_clashing_columns_and_empty(spark):
    assert _found(spark, [("2022-01-01", "HKF")], zone="x", local_us=1, utc_us=2, _s="y") == {0: "2021-12-31T16:00:00.000000Z"}
    assert _found(spark, [("2022-01-01", "HKF")][:0] or [(None, "HKF")]) == {}


def test_readings(spark):
    df = spark.createDataFrame([("2022-11-06 01:30:00",), ("2022-03-13 02:30:00",), ("2022-06-01 00:00:00",), ("2022-06-01T00:00:00Z",), ("?",)], "t string")
    out = resolve_instants(df.withColumn("d", F.lit(False)).withColumn("z", F.lit("America/New_York")), "t", "d", "z")
    assert [r.reading for r in out.collect()] == ["ambiguous", "nonexistent", "unique", "stated", "unreadable"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.datetimes(datetime(1801, 1, 1), datetime(2436, 1, 1)), st.sampled_from([s[1] for s in SOURCES])), min_size=20, max_size=60))
def test_against_zoneinfo(spark, cases):
    def expect(local, zone):
        """The first of two, and the offset before a gap: both are fold=0."""
        return (local.replace(tzinfo=ZoneInfo(zone), fold=0)).astimezone(timezone.utc)

    df = spark.createDataFrame([(i, t.strftime("%Y-%m-%d %H:%M:%S"), z, False) for i, (t, z) in enumerate(cases)], "i int, t string, z string, d boolean")
    got = {r.i: r.u for r in resolve_instants(df, "t", "d", "z").select("i", utc_text(F.col("utc_us")).alias("u")).collect()}
    for i, (t, z) in enumerate(cases):
        assert got[i] == expect(t.replace(microsecond=0), z).strftime("%Y-%m-%dT%H:%M:%S.000000Z")


def test_repeated_rows_stay(spark):
    flat = spark.createDataFrame([(1, "HKF", "2022-01-01", "2022-01-01")] * 3, "row_id long, source_code string, startdate string, reportdate string")
    sources = spark.createDataFrame(SOURCES, "source_code string, zone_name string, day_first boolean")
    assert instants_found(flat, sources).count() == 6


def test_year_boundaries(spark):
    base = datetime(2022, 1, 1)
    rows = [(base + timedelta(minutes=k - 5)).strftime("%Y-%m-%d %H:%M:%S") for k in range(10)]
    assert len(_found(spark, [(r, "HKF") for r in rows])) == 10


@pytest.mark.parametrize("text", ["1/2/2022", "01.02.22", "1-2-2022"])
def test_day_first(spark, text):
    assert _found(spark, [(text, "HKF"), (text, "NYC")]) == {0: "2022-01-31T16:00:00.000000Z", 1: "2022-01-01T16:00:00.000000Z"}


@pytest.mark.parametrize("zone", ["Asia/Gaza", "America/Sao_Paulo", "Africa/Casablanca", "Europe/Dublin", "Asia/Hong_Kong", "Antarctica/Troll"])
def test_intervals_against_every_day(zone):
    z, at = ZoneInfo(zone), datetime(1870, 1, 1, 1, 30, tzinfo=timezone.utc)
    spans = _intervals_of(zone)
    k = 0
    while at.year < 2110:
        t = int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds())
        while spans[k][1] <= t:
            k += 1
        assert spans[k][2] == at.astimezone(z).utcoffset().total_seconds()
        at += timedelta(hours=31)
