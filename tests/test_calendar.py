import datetime as dt

import pytest

from lmplake.feeds import DA_FEED, RT_UNVERIFIED_FEED, RT_VERIFIED_FEED, feed
from lmplake.functions.calendar import (
    civil_day_minutes, expected_at, is_first_of_day, is_last_of_day, next_business_day, request_delay,
)
from lmplake.operators.pulls import request_parameters


@pytest.mark.parametrize("day,expected", [
    (dt.date(2024, 1, 4), dt.date(2024, 1, 5)),
    (dt.date(2024, 1, 5), dt.date(2024, 1, 8)),
    (dt.date(2024, 1, 6), dt.date(2024, 1, 8)),
    (dt.date(2024, 1, 7), dt.date(2024, 1, 8)),
])
def test_next_business_day(spark, day, expected):
    df = spark.createDataFrame([(day,)], "d date")
    assert df.select(next_business_day("d").alias("x")).first().x == expected


def test_verified_availability_across_the_clock_change(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 8, 15),)], "b timestamp_ntz")
    got = df.select(expected_at(feed(RT_VERIFIED_FEED), "b").alias("e")).first().e
    assert got == dt.datetime(2024, 3, 11, 14)


def test_delays_when_due_and_when_ahead(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "b timestamp_ntz")
    now_past = "2024-02-01 00:00:00"
    r = df.select(*[request_delay(feed(f), "b", now_past).alias(f) for f in (DA_FEED, RT_VERIFIED_FEED, RT_UNVERIFIED_FEED)]).first()
    assert (r[0], r[1], r[2]) == (60, 0, 0)
    now_before = "2023-12-31 00:00:00"
    r = df.select(request_delay(feed(DA_FEED), "b", now_before).alias("d"),
                  request_delay(feed(RT_UNVERIFIED_FEED), "b", now_before).alias("u")).first()
    assert r.d == (dt.datetime(2023, 12, 31, 15) - dt.datetime(2023, 12, 31)).total_seconds()
    assert r.u == (dt.datetime(2024, 1, 1, 5, 5) - dt.datetime(2023, 12, 31)).total_seconds()


def test_request_windows_and_current_flag(spark):
    df = spark.createDataFrame([
        (DA_FEED, dt.datetime(2024, 1, 1, 5), 1), (RT_VERIFIED_FEED, dt.datetime(2024, 1, 1, 5), 1),
        (RT_UNVERIFIED_FEED, dt.datetime(2024, 1, 1, 5), 50001)],
        "feed string, begin_utc timestamp_ntz, start_row bigint")
    rows = {r.feed: r for r in request_parameters(df).collect()}
    assert rows[DA_FEED].datetime_beginning_utc == "01-01-2024 05:00 to 01-02-2024 04:00"
    assert rows[RT_VERIFIED_FEED].datetime_beginning_utc == "01-01-2024 05:00 to 01-01-2024 05:10"
    assert rows[RT_VERIFIED_FEED].row_is_current == "True"
    assert rows[RT_UNVERIFIED_FEED].row_is_current is None
    assert rows[RT_UNVERIFIED_FEED].StartRow == "50001" and rows[DA_FEED].rowCount == "50000"


def test_day_boundaries_and_civil_day_lengths(spark):
    df = spark.createDataFrame([
        (dt.datetime(2024, 11, 4, 4), dt.date(2024, 3, 10)),
        (dt.datetime(2024, 11, 4, 5), dt.date(2024, 11, 3)),
        (dt.datetime(2024, 1, 2, 4), dt.date(2024, 1, 2)),
    ], "u timestamp_ntz, d date")
    r = df.select(is_first_of_day("u").alias("f"), is_last_of_day("u", 60).alias("l"),
                  civil_day_minutes("d").alias("m")).collect()
    assert [(x.f, x.l, x.m) for x in r] == [(False, True, 23 * 60), (True, False, 25 * 60), (False, True, 24 * 60)]


def test_parameter_map_drops_absent_flag_and_mixed_feed_availability(spark):
    from lmplake.functions.calendar import expected_at_for
    from lmplake.operators.pulls import parameter_map
    df = spark.createDataFrame([
        (DA_FEED, dt.datetime(2024, 1, 1, 5), 1), (RT_UNVERIFIED_FEED, dt.datetime(2024, 1, 1, 5), 1),
        ("nope", dt.datetime(2024, 1, 1, 5), 1)],
        "feed string, begin_utc timestamp_ntz, start_row bigint")
    rows = {r.feed: r for r in request_parameters(df).select(
        "feed", parameter_map(request_parameters(df)).alias("m"),
        expected_at_for("feed", "begin_utc").alias("e")).collect()}
    assert "row_is_current" in rows[DA_FEED].m and "row_is_current" not in rows[RT_UNVERIFIED_FEED].m
    assert rows[DA_FEED].m["datetime_beginning_utc"] == "01-01-2024 05:00 to 01-02-2024 04:00"
    assert rows[DA_FEED].e == dt.datetime(2023, 12, 31, 15)
    assert rows[RT_UNVERIFIED_FEED].e == dt.datetime(2024, 1, 1, 5, 5)
    assert rows["nope"].e is None
