from __future__ import annotations

import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitloom.functions import clock, geo, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def km(spark, a, b, form):
    points = [F.lit(v).cast("double") for v in (*a, *b)]
    return one(spark, geo.haversine_km(*points, form=form))[0]


@pytest.mark.parametrize("form", ["atan2", "asin"])
def test_known_distances(spark, form):
    assert km(spark, (-23.5, -46.6), (-23.5, -46.6), form) == 0
    assert km(spark, (0, 0), (1, 0), form) == pytest.approx(6371 * math.pi / 180)
    assert km(spark, (0, 0), (0, 180), form) == pytest.approx(6371 * math.pi)
    assert km(spark, (90, 0), (-90, 0), form) == pytest.approx(6371 * math.pi)
    assert km(spark, (None, 0), (1, 0), form) is None


def test_unknown_form_is_refused(spark):
    with pytest.raises(ValueError):
        geo.haversine_km(F.lit(0), F.lit(0), F.lit(0), F.lit(0), form="flat")


point = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(point, point), min_size=20, max_size=40))
def test_distance_properties(spark, pairs):
    df = spark.createDataFrame([(*a, *b) for a, b in pairs], "la double, lo double, lb double, lp double")
    a, b = (F.col("la"), F.col("lo")), (F.col("lb"), F.col("lp"))
    for there, back, other in df.select(
        geo.haversine_km(*a, *b), geo.haversine_km(*b, *a), geo.haversine_km(*a, *b, form="asin")
    ).collect():
        assert 0 <= there <= 6371 * math.pi + 1e-6
        assert there == pytest.approx(back, abs=1e-6)
        # the asin form loses digits towards the antipode
        assert there == pytest.approx(other, abs=1e-3)


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_local_clock_ignores_the_session_zone(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        moment = clock.instant(F.lit("2024-01-01T02:30:15Z"))
        assert one(spark, clock.local_clock(moment)) == (datetime(2023, 12, 31, 23, 30, 15),)
        offset = clock.instant(F.lit("2024-01-01T02:30:15-05:00"))
        assert one(spark, clock.local_clock(offset)) == (datetime(2024, 1, 1, 4, 30, 15),)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_time_is_null(spark):
    df = spark.createDataFrame([("yesterday",), ("25/01/2024",), (None,)], "ta string")
    assert [r[0] for r in df.select(clock.instant(F.col("ta"))).collect()] == [None, None, None]


def test_elapsed_hours_counts_whole_seconds(spark):
    start = F.lit("2024-01-01 00:00:00.900").cast("timestamp_ntz")
    end = F.lit("2024-01-01 01:00:00.100").cast("timestamp_ntz")
    assert one(spark, clock.elapsed_hours(start, end)) == (1.0,)


def test_run_stamps_agree(spark):
    moment = datetime(2024, 2, 1, 6, 30, 5)
    assert clock.run_stamp(moment) == "20240201_063005"
    assert one(spark, clock.stamp_of(F.lit("2024-02-01 06:30:05").cast("timestamp"))) == ("20240201_063005",)


def test_sign_and_label(spark):
    null = F.lit(None).cast("string")
    assert one(spark, text.sign_code(F.lit("1012"), F.lit(10)), text.sign_code(F.lit("1012"), F.lit(None).cast("int"))) \
        == ("1012-10", None)
    assert one(spark, text.route_label(F.lit("1-1"), null)) == ("1-1 | Desc. Indisponível",)
    assert one(spark, text.route_label(null, F.lit("x"))) == ("? | x",)


def test_keys_flags_and_numbers(spark):
    assert one(spark, text.key_text(F.lit(123.0)), text.key_text(F.lit(" 7 ")), text.key_text(F.lit(9))) == ("123", "7", "9")
    flags = [F.lit(True), F.lit("True"), F.lit(1), F.lit(False), F.lit("no"), F.lit(None).cast("boolean")]
    assert one(spark, *[text.is_truthy(f).alias(str(i)) for i, f in enumerate(flags)]) == (True, True, True, False, False, False)
    assert one(spark, text.number_or_null(F.lit("1.5")), text.number_or_null(F.lit("x"))) == (1.5, None)
    assert one(spark, text.fixed_point(F.lit(1234.25), 1), text.grouped(F.lit(1234567.8))) == ("1234.2", "1,234,568")
