"""Availability calendar and market-day boundaries as Column expressions.

``now`` is always an argument (a literal or a column), never
``current_timestamp()``, so every result is reproducible.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lmplake.feeds import (
    DA_LEAD_HOURS,
    FEEDS,
    UNVERIFIED_LAG_MINUTES,
    VERIFIED_PUBLISH_HOUR,
    FeedSpec,
)
from lmplake.functions.time_cols import (
    _c,
    add_minutes,
    market_date,
    market_midnight_utc,
    market_time_utc,
)


def now_literal(now: datetime | str | Column) -> Column:
    if isinstance(now, Column):
        return now
    if isinstance(now, datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(now).cast("timestamp_ntz")


def next_business_day(day: Column | str) -> Column:
    """Day after ``day``, rolled from Saturday/Sunday to Monday (no holidays)."""
    nd = F.date_add(_c(day), 1)
    dow = F.dayofweek(nd)  # 1 = Sunday .. 7 = Saturday
    roll = F.when(dow == 7, F.lit(2)).when(dow == 1, F.lit(1)).otherwise(F.lit(0))
    return F.date_add(nd, roll)


def expected_at(spec: FeedSpec, begin_utc: Column | str) -> Column:
    """UTC instant at which the interval starting ``begin_utc`` is expected."""
    b = _c(begin_utc)
    if spec.availability == "lead":
        return F.timestamp_add("HOUR", F.lit(-DA_LEAD_HOURS), b)
    if spec.availability == "next_business_day":
        return market_time_utc(next_business_day(market_date(b)), VERIFIED_PUBLISH_HOUR)
    if spec.availability == "lag":
        return add_minutes(b, UNVERIFIED_LAG_MINUTES)
    raise ValueError(spec.availability)


def request_delay(spec: FeedSpec, begin_utc: Column | str, now) -> Column:
    """Seconds to wait before requesting ``begin_utc``; the feed's floor when due."""
    secs = F.timestamp_diff("SECOND", now_literal(now), expected_at(spec, begin_utc))
    return F.when(secs > 0, secs).otherwise(F.lit(spec.past_delay_secs).cast("bigint"))


def _by_feed(feed_col: Column | str, build) -> Column:
    f = _c(feed_col)
    out = None
    for name, spec in FEEDS.items():
        out = (F.when(f == name, build(spec)) if out is None else out.when(f == name, build(spec)))
    return out


def expected_at_for(feed_col: Column | str, begin_utc: Column | str) -> Column:
    """``expected_at`` for a frame that mixes feeds; NULL for unknown feeds."""
    return _by_feed(feed_col, lambda s: expected_at(s, begin_utc))


def request_delay_for(feed_col: Column | str, begin_utc: Column | str, now) -> Column:
    return _by_feed(feed_col, lambda s: request_delay(s, begin_utc, now))


def step_minutes_for(feed_col: Column | str) -> Column:
    return _by_feed(feed_col, lambda s: F.lit(s.step_minutes))


def span_minutes_for(feed_col: Column | str) -> Column:
    return _by_feed(feed_col, lambda s: F.lit(s.request_span_minutes))


def is_first_of_day(utcbegin: Column | str) -> Column:
    """Interval starts at New York midnight."""
    u = _c(utcbegin)
    return u == market_midnight_utc(market_date(u))


def is_last_of_day(utcbegin: Column | str, step_minutes: int | Column) -> Column:
    """The next interval belongs to a later New York day (New York on both sides)."""
    u = _c(utcbegin)
    return market_date(add_minutes(u, step_minutes)) > market_date(u)


def civil_day_minutes(day: Column | str) -> Column:
    """Length of a New York civil day in minutes (1380 / 1440 / 1500)."""
    d = _c(day)
    return F.timestamp_diff("MINUTE", market_midnight_utc(d), market_midnight_utc(F.date_add(d, 1)))
