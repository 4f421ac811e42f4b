"""Data-quality reports: gaps, day completeness, day boundaries, save targets
(J3, A7, A8, C18, C19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lmplake.feeds import FEEDS
from lmplake.functions.calendar import (
    civil_day_minutes,
    expected_at_for,
    is_first_of_day,
    is_last_of_day,
    now_literal,
    span_minutes_for,
    step_minutes_for,
)
from lmplake.functions.messages import fetch_message_json, queue_name
from lmplake.functions.time_cols import add_minutes, market_midnight_utc


GAP_BIN_DAYS = 32


def gap_ranges(df: DataFrame, group_cols: list[str], step_minutes: int, time_col: str = "utcbegin",
               bin_days: int = GAP_BIN_DAYS) -> DataFrame:
    """The gaps of each group as ranges: (groups, gap_start, gap_end, n_missing), from the first missing interval to
    the last one, between the group's first and last interval. A row for each gap, however long; rows without a time are left out.

    Each interval looks at the next one. A group is cut into bins of time, so that its rows - a group may hold a
    third of all - are ordered by many tasks; the last interval of a bin is handed the first one of the
    group's next bin, from a table with one row for each group and bin."""
    present = df.select(*group_cols, F.col(time_col).alias("_t")).where("_t is not null").distinct() \
        .withColumn("_bin", F.floor(F.date_diff(F.to_date("_t"), F.lit("1970-01-01").cast("date")) / bin_days))
    first = present.groupBy(*group_cols, "_bin").agg(F.min("_t").alias("_first"))
    handed = first.withColumn("_next_bin", F.lead("_first").over(Window.partitionBy(*group_cols).orderBy("_bin")))
    inside = present.withColumn("_next", F.lead("_t").over(Window.partitionBy(*group_cols, "_bin").orderBy("_t")))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group_cols]
    last = inside.where("_next is null").alias("a").join(
        handed.where("_next_bin is not null").alias("b"), [*same, F.col("a._bin") == F.col("b._bin")]) \
        .select(*[F.col(f"a.{c}").alias(c) for c in group_cols], "a._t", F.col("b._next_bin").alias("_next"))
    steps = F.ceil(F.timestamp_diff("MINUTE", F.col("_t"), F.col("_next")) / F.lit(step_minutes)).cast("bigint") - 1
    return inside.where("_next is not null").select(*group_cols, "_t", "_next").unionByName(last) \
        .withColumn("n_missing", steps).where("n_missing > 0") \
        .select(*group_cols, add_minutes("_t", step_minutes).alias("gap_start"),
                add_minutes("_t", (F.col("n_missing") * step_minutes).cast("int")).alias("gap_end"), "n_missing")


def interval_grid(bounds: DataFrame, group_cols: list[str], step_minutes: int,
                  lo_col: str = "lo", hi_col: str = "hi", out_col: str = "utcbegin") -> DataFrame:
    """Every interval start from ``lo`` to ``hi`` (inclusive) of each row.

    Generated in two steps - first one row per (row, UTC day), then the
    intervals of that day - so a range of years fans out over many
    tasks instead of exploding inside one. Intervals start on step
    boundaries, which midnight always is for the feeds' steps."""
    lo, hi = F.col(lo_col), F.col(hi_col)
    days = bounds.select(
        *group_cols, lo, hi,
        F.explode(F.sequence(F.to_date(lo), F.to_date(hi))).alias("_day"),
    ).repartition(*group_cols, "_day")
    day_start = F.col("_day").cast("timestamp_ntz")
    first = F.greatest(lo, day_start)
    last = F.least(hi, add_minutes(day_start, 24 * 60 - step_minutes))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(step_minutes))
    return days.select(*group_cols, F.explode(F.sequence(first, last, step)).alias(out_col))


def gap_report(df: DataFrame, group_cols: list[str], step_minutes: int, time_col: str = "utcbegin") -> DataFrame:
    """Intervals missing between each group's first and last interval, one row each: the ranges, listed."""
    return interval_grid(gap_ranges(df, group_cols, step_minutes, time_col), group_cols, step_minutes, "gap_start", "gap_end")


def refill_requests(gaps: DataFrame, feed_col: str = "feed") -> DataFrame:
    """Fetch messages that fill gaps (``gap_ranges`` with a feed column): each range is cut into requests of the feed's
    span, ranges of several groups that ask for the same window are one request.
    (feed, begin_utc, n_gaps, queue, message); the messages don't ask to continue."""
    known = gaps.where(F.col(feed_col).isin(list(FEEDS)))
    span = F.make_dt_interval(F.lit(0), F.lit(0), span_minutes_for(feed_col).cast("int"))
    begin = known.select(F.col(feed_col).alias("feed"), F.explode(F.sequence("gap_start", "gap_end", span)).alias("begin_utc"))
    asked = begin.groupBy("feed", "begin_utc").agg(F.count(F.lit(1)).alias("n_gaps"))
    return asked.select("feed", "begin_utc", "n_gaps", queue_name("feed").alias("queue"),
                        fetch_message_json("begin_utc", "feed", False).alias("message"))


def day_completeness(df: DataFrame, group_cols: list[str], step_minutes: int,
                     day_col: str = "pricedate") -> DataFrame:
    """Per group and market day: distinct intervals, first and last, against
    the civil day (23, 24 or 25 hours in New York)."""
    keys = [*group_cols, day_col]
    present = df.select(*keys, "utcbegin").distinct()
    per_day = present.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_intervals"),
        F.min("utcbegin").alias("first_utcbegin"),
        F.max("utcbegin").alias("last_utcbegin"),
    )
    expected = (civil_day_minutes(day_col) / F.lit(step_minutes)).cast("bigint")
    day_first = market_midnight_utc(day_col)
    day_last = add_minutes(market_midnight_utc(F.date_add(F.col(day_col), 1)), -step_minutes)
    return per_day.select(
        *keys, "n_intervals", "first_utcbegin", "last_utcbegin",
        expected.alias("expected_intervals"),
        ((F.col("first_utcbegin") == day_first) & (F.col("last_utcbegin") == day_last)
         & (F.col("n_intervals") == expected)).alias("complete"),
    )


def day_boundaries(df: DataFrame, step_minutes: int, time_col: str = "utcbegin") -> DataFrame:
    return df.withColumn("is_first_of_day", is_first_of_day(time_col)) \
             .withColumn("is_last_of_day", is_last_of_day(time_col, step_minutes))


def freshness_report(prices: DataFrame, group_cols: list[str], now, feed_col: str = "feed") -> DataFrame:
    """Per group: the last interval present, the next one expected, when the
    feed's calendar says it is published, and how many seconds it is overdue
    at ``now`` (negative: not due yet)."""
    last = prices.groupBy(*group_cols).agg(F.max("utcbegin").alias("last_utcbegin"))
    nxt = add_minutes("last_utcbegin", step_minutes_for(feed_col))
    out = last.withColumn("next_utcbegin", nxt).withColumn(
        "expected_at", expected_at_for(feed_col, "next_utcbegin"))
    return out.withColumn("overdue_secs", F.timestamp_diff("SECOND", F.col("expected_at"), now_literal(now)))


def save_targets(df: DataFrame, spec=None, day_col: str = "pricedate", part_cols: tuple[str, ...] = ()) -> DataFrame:
    """Distinct market days to (re)write, the month each belongs to, and the
    save target: the day for sub-daily feeds, the month otherwise (C19)."""
    out = df.select(*part_cols, day_col).distinct().withColumn("month", F.trunc(F.col(day_col), "MM"))
    if spec is not None:
        out = out.withColumn("save_target", F.col(day_col) if spec.is_sub_daily else F.col("month"))
    return out
