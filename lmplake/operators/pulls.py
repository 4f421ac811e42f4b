"""Pull bookkeeping: page plan, request parameters, page completeness,
first-day filter, cursor and next requests (S5, S6, P4, P8, P9, A1, A2, K7).

Each operator works on a *table of pulls* keyed by caller-chosen columns, so
thousands of feeds/intervals are planned in one job; nothing loops on the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmplake.feeds import FEEDS, PAGE_SIZE
from lmplake.functions.calendar import now_literal, request_delay_for, span_minutes_for, step_minutes_for
from lmplake.functions.messages import base64_text, fetch_message_json, queue_name
from lmplake.functions.time_cols import _c, add_minutes, api_time_text
from lmplake.operators.skew import attach_group_stats


def n_pages(total_rows: Column | str, page_size: int = PAGE_SIZE) -> Column:
    t = _c(total_rows)
    return F.when(t > 0, F.ceil(t / F.lit(page_size))).otherwise(F.lit(0)).cast("bigint")


def page_plan(totals: DataFrame, pull_cols: list[str], total_col: str = "total_rows",
              page_size: int = PAGE_SIZE) -> DataFrame:
    """One row per page to request: ``page_index`` from 0, ``start_row`` from 1.
    Pulls with no rows get no pages (guarded: ``sequence(0, -1)`` is not empty)."""
    return (
        totals.where(F.col(total_col) > 0)
        .select(*pull_cols, F.explode(F.sequence(F.lit(0).cast("bigint"), n_pages(total_col, page_size) - 1))
                .alias("page_index"))
        .withColumn("start_row", F.col("page_index") * F.lit(page_size) + F.lit(1))
    )


def request_end(feed_col: Column | str, begin_utc: Column | str) -> Column:
    return add_minutes(begin_utc, span_minutes_for(feed_col))


def request_parameters(df: DataFrame, feed_col: str = "feed", begin_col: str = "begin_utc",
                       start_row_col: str = "start_row", page_size: int = PAGE_SIZE) -> DataFrame:
    """Append the API query parameters of each request as columns.
    ``row_is_current`` is NULL (absent) for the unverified feed."""
    fields = F.lit(None).cast("string")
    current = F.lit(None).cast("string")
    for name, spec in FEEDS.items():
        fields = F.when(F.col(feed_col) == name, F.lit(",".join(spec.api_fields))).otherwise(fields)
        current = F.when(F.col(feed_col) == name, F.lit("True") if spec.row_is_current else F.lit(None)).otherwise(current)
    window_text = F.concat_ws(" to ", api_time_text(begin_col), api_time_text(request_end(feed_col, begin_col)))
    return df.select(
        "*",
        F.lit(str(page_size)).alias("rowCount"),
        F.col(start_row_col).cast("string").alias("StartRow"),
        F.lit("True").alias("download"),
        current.alias("row_is_current"),
        window_text.alias("datetime_beginning_utc"),
        fields.alias("fields"),
    )


def parameter_map(df: DataFrame) -> Column:
    """The parameters as one ``map<string,string>``, for a transport at the edge."""
    names = ["rowCount", "StartRow", "download", "row_is_current", "datetime_beginning_utc", "fields"]
    m = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def first_day_filter(prices: DataFrame, pull_cols: list[str], day_col: str = "pricedate") -> DataFrame:
    """Keep only the earliest market day of each pull.

    The per-pull minimum is a partial aggregate (one row per pull), joined
    back on ``(pull, day)`` with ``attach_group_stats``: heavy pulls by a
    size-bounded broadcast, so a pull holding a third of the rows is never
    shuffled into one task. Never an unpartitioned window."""
    first = prices.groupBy(*pull_cols).agg(F.min(day_col).alias(day_col), F.count(F.lit(1)).alias("_cnt"))
    return attach_group_stats(prices, first, pull_cols, [*pull_cols, day_col], "left_semi")


def next_cursor(prices: DataFrame, group_cols: list[str], feed_col: str = "feed") -> DataFrame:
    """Next interval to request per group: ``max(utcbegin) + step`` of the feed."""
    cur = prices.groupBy(*group_cols).agg(F.max("utcbegin").alias("last_utcbegin"))
    return cur.withColumn("next_begin_utc", add_minutes("last_utcbegin", step_minutes_for(feed_col)))


def page_completeness(received: DataFrame, headers: DataFrame, pull_cols: list[str],
                      page_size: int = PAGE_SIZE) -> DataFrame:
    """Per pull: expected pages from the row-count header against pages that
    arrived (``start_row``, ``n_rows``). Complete means no page missing, none
    unexpected, and the rows add up to the header."""
    expected = page_plan(headers, pull_cols, "total_rows", page_size).select(*pull_cols, "start_row")
    got = received.select(*pull_cols, "start_row", "n_rows")
    missing = expected.join(got, [*pull_cols, "start_row"], "left_anti").groupBy(*pull_cols) \
        .agg(F.count(F.lit(1)).alias("missing_pages"))
    extra = got.join(expected, [*pull_cols, "start_row"], "left_anti").groupBy(*pull_cols) \
        .agg(F.count(F.lit(1)).alias("unexpected_pages"))
    arrived = got.groupBy(*pull_cols).agg(
        F.count(F.lit(1)).alias("received_pages"), F.sum("n_rows").cast("bigint").alias("received_rows"))
    out = (
        headers.select(*pull_cols, F.col("total_rows").cast("bigint").alias("total_rows"),
                       n_pages("total_rows", page_size).alias("expected_pages"))
        .join(arrived, pull_cols, "left")
        .join(missing, pull_cols, "left")
        .join(extra, pull_cols, "left")
    )
    out = out.fillna(0, ["received_pages", "received_rows", "missing_pages", "unexpected_pages"])
    return out.withColumn(
        "complete",
        (F.col("missing_pages") == 0) & (F.col("unexpected_pages") == 0) & (F.col("received_rows") == F.col("total_rows")),
    )


def next_requests(requests: DataFrame, pulled: DataFrame, request_cols: list[str], now,
                  feed_col: str = "feed", begin_col: str = "begin_utc") -> DataFrame:
    """Work items that follow a set of pulls.

    ``requests`` holds one row per pull that was asked for (``request_cols``
    identify it and include ``feed_col``/``begin_col``/``queue_next``);
    ``pulled`` holds the rows each pull produced (after the first-day filter).
    A pull with rows continues at ``max(utcbegin) + step`` when it asked to;
    a pull with no rows is asked again for the same interval. ``not_before``
    is ``now`` plus the feed's availability delay."""
    got = pulled.groupBy(*request_cols).agg(F.count(F.lit(1)).alias("n_rows"), F.max("utcbegin").alias("_last"))
    j = requests.join(got, request_cols, "left").fillna(0, ["n_rows"])
    empty = F.col("n_rows") == 0
    nb = F.when(empty, F.col(begin_col)).otherwise(add_minutes("_last", step_minutes_for(feed_col)))
    out = (
        j.where(empty | F.col("queue_next"))
        .withColumn("next_begin_utc", nb)
        .withColumn("delay_secs", request_delay_for(feed_col, "next_begin_utc", now))
        .withColumn("not_before", F.timestamp_add("SECOND", F.col("delay_secs"), now_literal(now)))
    )
    qn = F.when(empty, F.col("queue_next")).otherwise(F.lit(True))
    msg = fetch_message_json("next_begin_utc", feed_col, qn)
    return out.select(
        *request_cols, "n_rows", "next_begin_utc", "delay_secs", "not_before",
        queue_name(feed_col).alias("queue"), msg.alias("message"), base64_text(msg).alias("payload"),
    )


def coalesce_merge_requests(decoded: DataFrame) -> DataFrame:
    """Distinct (feed, day) merge requests with how many arrived (T5).

    Counted with a conditional aggregate rather than ``where(kind = 'merge')``:
    a filter on a decoded column is pushed below the decode and would parse
    the message again for every reference to ``kind``."""
    g = decoded.groupBy("feed", "merge_date").agg(
        F.count(F.when(F.col("kind") == "merge", F.lit(1))).alias("n_requests"))
    return g.where(F.col("n_requests") > 0)


def due_requests(requests: DataFrame, now) -> DataFrame:
    """Requests whose time has come (``not_before <= now``); ``now`` is a parameter."""
    return requests.where(F.col("not_before") <= now_literal(now))


def release_requests(spark, requests_dir: str, message_dir: str, released_dir: str, now, release_id: int) -> DataFrame:
    """Turn due request rows into messages that the control stream reads: closes the
    loop from a cycle's next requests to the next cycle.

    A release writes its rows to the ledger ``released_dir/release_id=N`` and their
    messages to ``message_dir/release_id=N``, each replaced whole; rows that another
    release has in the ledger are left out. So a release that is run again gives the
    same messages, and a request is released once."""
    rows = spark.read.parquet(requests_dir)
    keys = ["batch_id", "feed", "pull"]
    due = due_requests(rows, now).select(*keys, "message")
    from lmplake.sources.paths import exists
    if exists(released_dir):
        done = spark.read.schema("batch_id bigint, feed string, pull string, message string, release_id bigint") \
            .parquet(released_dir).where(F.col("release_id") != int(release_id)).select(*keys)
        due = due.join(done, keys, "left_anti")
    ledger = f"{released_dir.rstrip('/')}/release_id={int(release_id)}"
    due.write.mode("overwrite").parquet(ledger)
    out = spark.read.schema("batch_id bigint, feed string, pull string, message string").parquet(ledger)
    out.select(F.col("message").alias("value")).write.mode("overwrite").text(f"{message_dir.rstrip('/')}/release_id={int(release_id)}")
    return out
