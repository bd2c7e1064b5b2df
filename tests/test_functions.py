"""Value rules V1-V18 on hand-made rows."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructField, StructType

from fleetpulse.functions import scalar as S
from fleetpulse.functions.aggregates import (round_mean_int_2dp,
                                             round_mean_tenths_2dp,
                                             round_pct_1dp)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_delay_bucket_thresholds_and_null_quirk(spark):   # V1, V2
    df = spark.createDataFrame([(-61,), (-60,), (120,), (121,), (None,)], "delay int")
    out = rows(df.select("delay", S.delay_bucket().alias("b"), S.is_delayed().alias("d")))
    assert out == [(-61, "early", False), (-60, "on_time", False), (120, "on_time", False),
                   (121, "delayed", True), (None, "delayed", None)]


def test_speed_flags_and_trip(spark):                      # V3, V5, V6
    df = spark.createDataFrame([(-1, 1, 0), (0, None, 1), (1, 2, None), (None, 3, 2)],
                               "speed int, tripId int, gpsQuality int")
    out = rows(df.select(S.is_stopped(), S.is_moving(), S.has_trip(), S.gps_ok()))
    assert out == [(False, False, True, False), (True, False, False, True),
                   (False, True, True, None), (None, None, True, True)]


def test_box_float_edges(spark):                           # V7
    schema = StructType([StructField("lat", FloatType()), StructField("lon", FloatType())])
    df = spark.createDataFrame([(54.2, 18.5), (54.6, 18.5), (54.4, 18.3), (54.4, 19.0),
                                (0.0, 0.0), (None, 18.5)], schema)
    got = rows(df.select(S.in_box()))
    # 18.3f is 18.2999992..., below the double literal: excluded
    assert got == [(True,), (True,), (False,), (True,), (False,), (None,)]
    assert df.filter(S.in_box()).count() == 3


def test_delay_min_rounding_matches_integer_rule(spark):   # V8
    df = spark.range(-3000, 3001).select(F.col("id").cast("int").alias("delay"))
    bad = df.select(
        "delay", S.delay_min().alias("m"),
        (F.signum("delay") * F.floor((F.abs("delay") * 2 + 6) / 12) / 10.0).alias("exact"),
    ).filter(F.col("m") != F.col("exact"))
    assert bad.count() == 0
    assert rows(spark.createDataFrame([(3,), (-3,), (9,)], "delay int")
                .select(S.delay_min())) == [(0.1,), (-0.1,), (0.2,)]


def test_local_time_dst(spark):                            # V10
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 10, 0),), (dt.datetime(2024, 1, 15, 10, 0),)],
                               "t timestamp_ntz")
    out = [r[0] for r in df.select(S.local_time("t")).collect()]
    assert out == [dt.datetime(2024, 7, 1, 12, 0), dt.datetime(2024, 1, 15, 11, 0)]


def test_utc_time_bad_text_and_session_zone(spark):        # FN5
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-01-01T00:00:07.5Z",), ("bad",), (None,)], "g string")
        out = [r[0] for r in df.select(S.utc_time("g")).collect()]
        assert out == [dt.datetime(2024, 1, 1, 0, 0, 7, 500000), None, None]
        back = df.select(S.utc_instant(S.utc_time("g")).alias("i")).select(
            F.convert_timezone(None, F.lit("UTC"), "i")).collect()[0][0]
        assert back == dt.datetime(2024, 1, 1, 0, 0, 7, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Warsaw", "America/New_York", "Asia/Kolkata"])
def test_times_exact_in_dst_overlap_under_any_session_zone(spark, zone):   # FN5, FN6
    # 00:30Z and 01:30Z on 2021-10-31 are both 02:30 on a Warsaw wall clock
    # (the overlap hour), 01:30Z on 2021-03-28 is in the spring gap.
    texts = ["2021-10-31T00:30:00Z", "2021-10-31T01:30:00Z", "2021-03-28T01:30:00Z",
             "2021-03-14T07:30:00Z", "2024-01-01T10:00:00+01:00"]
    utc = [dt.datetime(2021, 10, 31, 0, 30), dt.datetime(2021, 10, 31, 1, 30),
           dt.datetime(2021, 3, 28, 1, 30), dt.datetime(2021, 3, 14, 7, 30),
           dt.datetime(2024, 1, 1, 9, 0)]
    local = [dt.datetime(2021, 10, 31, 2, 30), dt.datetime(2021, 10, 31, 2, 30),
             dt.datetime(2021, 3, 28, 3, 30), dt.datetime(2021, 3, 14, 8, 30),
             dt.datetime(2024, 1, 1, 10, 0)]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, g string")
        out = df.select("i", S.utc_time("g").alias("u")).select(
            "i", "u", S.local_time("u").alias("l"),
            F.unix_micros(S.utc_instant("u")).alias("m")).orderBy("i").collect()
        assert [r.u for r in out] == utc
        assert [r.l for r in out] == local
        epoch = dt.datetime(1970, 1, 1)
        assert [r.m for r in out] == [(u - epoch) // dt.timedelta(microseconds=1) for u in utc]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_type_normalise(spark):                            # V11
    df = spark.createDataFrame([("Autobus",), ("Tramwaj",), ("Trolejbus",), (None,)], "t string")
    assert rows(df.select(S.normalise_type("t"))) == [("Bus",), ("Tram",), ("Trolejbus",), (None,)]


def test_marker_color_and_popup(spark):                    # V18, FN18
    df = spark.createDataFrame([("6", 121), ("6", 120), (None, None)], "r string, d int")
    out = rows(df.select(S.marker_color("d"), S.marker_popup("r", "d")))
    assert out == [("red", "6 | Delay: 121 s"), ("green", "6 | Delay: 120 s"),
                   ("green", "None | Delay: None s")]


def test_snapshot_name(spark):                             # FN20
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 7, 5, 2),)], "t timestamp_ntz")
    assert df.select(S.snapshot_name("t")).first()[0] == "gps_20240309_070502.json"


def test_exact_rounded_means(spark):                       # AF4, AF5, AF7
    df = spark.createDataFrame([(5, 2, 1, 8), (-5, 2, 0, 0), (1, 8, 1, 3), (0, 0, 0, 0)],
                               "s long, n long, t long, m long")
    out = rows(df.select(round_mean_tenths_2dp(F.col("s"), F.col("n")),
                         round_mean_int_2dp(F.col("s"), F.col("n")),
                         round_pct_1dp(F.col("t"), F.col("n"))))
    # 5 tenths / 2 = 0.25 min exactly -> 0.25; ties go away from zero
    assert out[0] == (0.25, 2.5, 50.0)
    assert out[1][0] == -0.25 and out[1][2] == 0.0   # int mean is for sums >= 0
    assert out[2] == (0.01, 0.13, 12.5)       # 0.0125 -> 0.01 ; 0.125 -> 0.13
    assert out[3] == (None, None, None)


_EPOCH = dt.datetime(1970, 1, 1)
_FROM = (dt.datetime(2000, 1, 1) - _EPOCH) // dt.timedelta(microseconds=1)
_TO = (dt.datetime(2037, 12, 31) - _EPOCH) // dt.timedelta(microseconds=1)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(_FROM, _TO), min_size=1, max_size=40))
def test_local_time_matches_zoneinfo(spark, micros):        # FN6, property
    df = spark.createDataFrame([(m,) for m in micros], "m long")
    out = df.select("m", S.local_time(S.utc_of_instant(F.timestamp_micros("m"))).alias("l")) \
            .collect()
    zone = ZoneInfo("Europe/Warsaw")
    for r in out:
        utc = (_EPOCH + dt.timedelta(microseconds=r.m)).replace(tzinfo=dt.timezone.utc)
        assert r.l == utc.astimezone(zone).replace(tzinfo=None)
