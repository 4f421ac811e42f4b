"""Registered queries: each reads the driver tables through the adapters
and runs one operator of the lake over the whole input.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB statement of the same key in ``lmplake.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.feeds import DA_FEED, RAW_NODE_FIELD, RT_UNVERIFIED_FEED, RT_VERIFIED_FEED, feed
from lmplake.functions.calendar import expected_at, request_delay
from lmplake.functions.messages import decode_messages, rejected_messages
from lmplake.functions.time_cols import floor_to_step, market_midnight_utc, parse_utc_strict, raw_time_text, api_time_text
from lmplake.operators import merge as M
from lmplake.operators import pulls as P
from lmplake.operators import quality as Q
from lmplake.operators.normalize import normalize_prices, quarantine_summary
from lmplake.operators.serve import asset_dimension, asset_lookup, asset_upsert
from lmplake.plans import adapters as A
from lmplake.session import lake_root, reliable_checkpoint
from lmplake.sinks.lake import land_intake, merge_into_day_table, order_pulls, serving_table_path, stamp_ingest_seq, \
    sweep_intake, upsert_serving
from lmplake.sinks.landings import start_landing
from lmplake.sinks.versions import merge_versioned, read_nodes, read_versioned, table_carried_over, table_nodes
from lmplake.sources.feed_source import read_feed, read_feed_stream, write_page_folder
from lmplake.sources.intake import list_files
from lmplake.sources.pages import build_pages, parse_page_text, read_json_pages
from lmplake.streaming.streams import FINISHED, REQUESTED, control_message_stream, start_day_merge, start_merge_actions, \
    start_pending_merges, start_serving_upsert
from lmplake.streaming.timers import request_stream, start_timed_release

DA = feed(DA_FEED)
# Fixed evaluation instants (``now`` is a parameter, never the wall clock).
EVENTS_NOW = "2024-01-15 12:00:00"
ORDERS_NOW = "2001-07-15 12:00:00"
# Event type -> feed for request windows (all five types request a feed).
REQUEST_FEED = {
    "click": DA_FEED,
    "signup": DA_FEED,
    "view": RT_VERIFIED_FEED,
    "error": RT_VERIFIED_FEED,
    "purchase": RT_UNVERIFIED_FEED,
}

# Lake schema: fixed-width columns only, so latest-wins stays a hash aggregate
# (a string value column would force a sort aggregate).
PRICE_COLS = ["utcbegin", "pricedate", "hour", "node_id", "dalmp", "damcc", "damcl", "ingest_seq"]


def _existing_new(spark, sf_dir):
    p = A.events_prices(spark, sf_dir)
    b = A.arrival_batch()
    return p.where(b == 0), p.where(b == 1)


def normalize_prices_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.orders_prices(spark, sf_dir)


def scan_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = A.events_raw(spark, sf_dir)
    pages = build_pages(raw, DA, ["pull_id"], "ingest_seq", A.ADAPTER_PAGE_SIZE)
    records = parse_page_text(pages, DA, keep=("pull_id", "page_index"))
    return normalize_prices(records, DA, keep=("pull_id", "page_index"))


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = A.table(spark, sf_dir, "events")
    raw = ev.select(F.col("event_id").alias("ingest_seq"), raw_time_text("ts").alias("raw_text"))
    u = parse_utc_strict("raw_text")
    return raw.select("ingest_seq", "raw_text", u.alias("utcbegin"),
                      raw_time_text(u).alias("round_trip"), api_time_text(u).alias("api_text"))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_summary(A.events_raw_dirty(spark, sf_dir), DA, ("pull_id",))


def scan_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files as the API sends them (JSON with plain numbers), written and scanned."""
    raw = A.events_raw(spark, sf_dir)
    root = f"{lake_root(spark)}/json"
    numbers = {c: F.col(c).cast("double") for c in DA.price_fields} | {RAW_NODE_FIELD: F.col(RAW_NODE_FIELD).cast("bigint")}
    pages = build_pages(raw.withColumns(numbers), DA, ["pull_id"], "ingest_seq", A.ADAPTER_PAGE_SIZE)
    pages.select("pull_id", "start_row", "page_text").write.partitionBy("pull_id", "start_row").text(root)
    return normalize_prices(read_json_pages(spark, root, DA, with_provenance=False), DA)


def overlapping_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle with overlapping pulls, merged: the pull that begins later wins."""
    rows, requests = A.overlapping_pulls(spark, sf_dir)
    stamped = stamp_ingest_seq(order_pulls(rows, requests), 1, "cycle_row")
    return M.latest_wins(stamped.select(*PRICE_COLS), ["node_id", "utcbegin"], "ingest_seq").drop("ingest_seq")


def latest_wins_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.latest_wins(A.events_prices(spark, sf_dir).select(*PRICE_COLS), ["node_id", "utcbegin"], "ingest_seq")


def first_day_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.first_day_filter(A.events_prices(spark, sf_dir), ["pull_id"])


def next_cursor_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    da = A.events_prices(spark, sf_dir, DA_FEED).withColumn("feed", F.lit(DA_FEED))
    rt = A.events_prices(spark, sf_dir, RT_VERIFIED_FEED).withColumn("feed", F.lit(RT_VERIFIED_FEED))
    both = da.select("feed", "pull_id", "utcbegin").unionByName(rt.select("feed", "pull_id", "utcbegin"))
    return P.next_cursor(both, ["feed", "pull_id"])


def _pull_totals(spark, sf_dir):
    return A.events_raw(spark, sf_dir).groupBy("pull_id").agg(F.count(F.lit(1)).alias("total_rows"))


def page_plan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.page_plan(_pull_totals(spark, sf_dir), ["pull_id"], "total_rows", A.ADAPTER_PAGE_SIZE)


def page_completeness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = A.events_raw(spark, sf_dir)
    pages = build_pages(raw, DA, ["pull_id"], "ingest_seq", A.ADAPTER_PAGE_SIZE).select("pull_id", "start_row", "n_rows", "page_index")
    lost = F.col("pull_id").isin("view", "signup") & (F.col("page_index") % 3 == 1)
    stray = pages.where(F.col("pull_id").isin("error", "signup") & (F.col("page_index") == 0)) \
        .withColumns({"start_row": F.lit(3).cast("bigint"), "n_rows": F.lit(1).cast("bigint")})
    pages = pages.where(~lost).unionByName(stray).drop("page_index")
    return P.page_completeness(pages, _pull_totals(spark, sf_dir), ["pull_id"], A.ADAPTER_PAGE_SIZE)


def _event_feed():
    f = F.lit(None).cast("string")
    for et, fd in REQUEST_FEED.items():
        f = F.when(F.col("event_type") == et, F.lit(fd)).otherwise(f)
    return f


def request_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = A.table(spark, sf_dir, "events").withColumn("feed", _event_feed())
    begin = F.when(F.col("feed") == DA_FEED, floor_to_step("ts", 60)).otherwise(floor_to_step("ts", 5))
    req = ev.select(F.col("event_id").alias("ingest_seq"), "feed", begin.alias("begin_utc"),
                    F.lit(1).cast("bigint").alias("start_row"))
    out = P.request_parameters(req)
    return out.withColumn("end_utc", P.request_end("feed", "begin_utc"))


def _event_hours(spark, sf_dir):
    ev = A.table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("ingest_seq"), floor_to_step("ts", 60).alias("begin_utc"))


def expected_at_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_hours(spark, sf_dir).select(
        "ingest_seq", "begin_utc",
        expected_at(feed(DA_FEED), "begin_utc").alias("expected_da"),
        expected_at(feed(RT_VERIFIED_FEED), "begin_utc").alias("expected_verified"),
        expected_at(feed(RT_UNVERIFIED_FEED), "begin_utc").alias("expected_unverified"),
    )


def request_delay_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_hours(spark, sf_dir).select(
        "ingest_seq", "begin_utc",
        request_delay(feed(DA_FEED), "begin_utc", EVENTS_NOW).alias("delay_da"),
        request_delay(feed(RT_VERIFIED_FEED), "begin_utc", EVENTS_NOW).alias("delay_verified"),
        request_delay(feed(RT_UNVERIFIED_FEED), "begin_utc", EVENTS_NOW).alias("delay_unverified"),
    )


def control_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = decode_messages(A.event_messages(spark, sf_dir, envelopes=True), envelope=True)
    return msgs.select("ingest_seq", "kind", "feed", "begin_utc", "queue_next", "merge_date")


def pending_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.coalesce_merge_requests(decode_messages(A.event_messages(spark, sf_dir)))


def quarantined_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that a worker with two feeds rejects: bad ones (merges of a day that doesn't
    exist among them) and those of a feed without a transport."""
    msgs = decode_messages(A.event_messages(spark, sf_dir, bad_days=True))
    return rejected_messages(msgs, [DA_FEED, RT_VERIFIED_FEED]).select("ingest_seq", "kind", "feed")


def stream_pending_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge requests in three waves over the same days, older days after newer ones: each
    wave asks for its days again."""
    root = lake_root(spark)
    msgs = A.event_messages(spark, sf_dir)
    for wave in range(3):
        msgs.where(F.col("ingest_seq") % 3 == wave).select("value").write.text(f"{root}/msgs/wave{wave}")
        start_pending_merges(control_message_stream(spark, f"{root}/msgs"), f"{root}/pending", f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/pending").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def due_requests_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = P.due_requests(next_requests_q(spark, sf_dir), "2001-07-15 13:00:00")
    return due.select("feed", "pull_id", "pricedate", "not_before", "message")


def next_requests_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = A.orders_prices(spark, sf_dir)
    days = prices.groupBy("pull_id").agg(F.min("pricedate").alias("lo"), F.max("pricedate").alias("hi"))
    requests = days.select("pull_id", F.explode(F.sequence("lo", "hi")).alias("pricedate")).select(
        F.lit(DA_FEED).alias("feed"), "pull_id", "pricedate",
        market_midnight_utc("pricedate").alias("begin_utc"), F.lit(True).alias("queue_next"))
    pulled = prices.withColumn("feed", F.lit(DA_FEED))
    return P.next_requests(requests, pulled, ["feed", "pull_id", "pricedate"], ORDERS_NOW)


def day_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, new = _existing_new(spark, sf_dir)
    return M.merge_rows(existing.select(*PRICE_COLS), new.select(*PRICE_COLS), ("node_id", "utcbegin"))


def carried_over_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, new = _existing_new(spark, sf_dir)
    return M.carried_over_nodes(existing, new)


def input_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.input_manifest(A.with_intake_file(A.events_prices(spark, sf_dir)), root=DA_FEED)


def unprocessed_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = A.with_intake_file(A.events_prices(spark, sf_dir))
    files = landed.select("file_path").distinct()
    ledger = landed.where(A.arrival_batch() == 0).select("file_path")
    return M.unprocessed_inputs(files, ledger)


def node_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.node_inventory(day_merge(spark, sf_dir))


def node_day_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.node_day_lookup(day_merge(spark, sf_dir), [n for n, _ in A.TEST_ASSETS])


def asset_lookup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = asset_dimension(spark, A.TEST_ASSETS)
    return asset_lookup(A.events_prices(spark, sf_dir), assets, DA, keep=("ingest_seq",))


def asset_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = asset_dimension(spark, A.TEST_ASSETS)
    existing, new = _existing_new(spark, sf_dir)
    serving = asset_lookup(existing, assets, DA, keep=("ingest_seq",))
    batch = asset_lookup(new, assets, DA, keep=("ingest_seq",))
    return asset_upsert(serving, batch, DA)


def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.gap_report(A.events_prices(spark, sf_dir), ["pull_id"], DA.step_minutes)


def gap_report_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing hours per node between its first and last interval (J3 per node)."""
    return Q.gap_report(A.events_prices(spark, sf_dir), ["node_id"], DA.step_minutes)


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How overdue the next interval of each (feed, pull) is at a fixed now."""
    da = A.events_prices(spark, sf_dir, DA_FEED).withColumn("feed", F.lit(DA_FEED))
    rt = A.events_prices(spark, sf_dir, RT_VERIFIED_FEED).withColumn("feed", F.lit(RT_VERIFIED_FEED))
    both = da.select("feed", "pull_id", "utcbegin").unionByName(rt.select("feed", "pull_id", "utcbegin"))
    return Q.freshness_report(both, ["feed", "pull_id"], EVENTS_NOW)


def day_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.day_completeness(A.events_prices(spark, sf_dir), ["pull_id"], DA.step_minutes)


def day_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.day_boundaries(A.boundary_prices(spark, sf_dir), DA.step_minutes)


def save_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.save_targets(A.orders_prices(spark, sf_dir), DA)


# The adapters' pages are small (500 rows), so several go to one read task.
PAGES_PER_TASK = 8


def _land_event_pages(spark, sf_dir, root):
    raw = A.events_raw(spark, sf_dir)
    pages = build_pages(raw, DA, ["pull_id"], "ingest_seq", A.ADAPTER_PAGE_SIZE).withColumnRenamed("pull_id", "pull")
    headers = raw.groupBy(F.col("pull_id").alias("pull")).agg(F.count(F.lit(1)).alias("total_rows"))
    write_page_folder(pages, headers, root, DA_FEED)


def feed_source_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed by Spark, planned from their headers on the driver and
    fetched per page on executors through the Python Data Source."""
    root = lake_root(spark)
    _land_event_pages(spark, sf_dir, root)
    recs = read_feed(spark, {"root": root, "feed": DA_FEED, "page_size": A.ADAPTER_PAGE_SIZE,
                             "pages_per_partition": PAGES_PER_TASK})
    return normalize_prices(recs, DA, keep=("pull", "start_row", "api_row")).withColumnRenamed("pull", "pull_id")


def feed_source_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page plan of the feed source, from the landed headers only."""
    from lmplake.sources.feed_source import page_plan_frame
    root = lake_root(spark)
    _land_event_pages(spark, sf_dir, root)
    return page_plan_frame(spark, {"root": root, "feed": DA_FEED, "page_size": A.ADAPTER_PAGE_SIZE})


def list_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the landed pages by pull and start row, listed without reading them."""
    root = lake_root(spark)
    _land_event_pages(spark, sf_dir, root)
    files = list_files(spark, root, "*.txt").withColumn("pull", F.regexp_extract("path", r"/pull=([^/]*)/", 1)) \
        .withColumn("start_row", F.regexp_extract("path", r"/start_row=(\d+)/", 1).cast("bigint"))
    return files.groupBy("pull", "start_row").agg(F.count(F.lit(1)).alias("n_files"), F.min(F.col("length") > 0).alias("has_bytes"))


def serving_rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute prices upserted into the real-time serving table (the feed's own target)."""
    spec = feed(RT_VERIFIED_FEED)
    root = f"{lake_root(spark)}/serving"
    prices = A.events_prices(spark, sf_dir, RT_VERIFIED_FEED)
    upsert_serving(spark, serving_table_path(root, spec), prices, asset_dimension(spark, A.TEST_ASSETS), spec)
    return spark.read.parquet(f"{root}/rt")


def land_intake_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event prices landed in an intake (per-day folders) and read back."""
    root = lake_root(spark)
    land_intake(A.events_prices(spark, sf_dir), f"{root}/intake", DA)
    return spark.read.parquet(f"{root}/intake").drop("landing")


def fetch_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole fetch cycle over the event pages: one request per pull,
    starting at the pull's first hour, run twice as after a failure; returns the request
    table that is left."""
    from lmplake.plans.cycle import run_fetch_cycle
    root = lake_root(spark)
    _land_event_pages(spark, sf_dir, f"{root}/pages")
    requests = A.events_prices(spark, sf_dir).groupBy(F.col("pull_id").alias("pull")).agg(
        F.min("utcbegin").alias("begin_utc")).select(
        F.lit(DA_FEED).alias("feed"), "pull", "begin_utc", F.lit(True).alias("queue_next"))
    for _ in range(2):
        run_fetch_cycle(spark, requests, DA_FEED, {"root": f"{root}/pages", "page_size": A.ADAPTER_PAGE_SIZE,
                                                  "pages_per_partition": PAGES_PER_TASK},
                        f"{root}/intake", f"{root}/serving", asset_dimension(spark, A.TEST_ASSETS),
                        landing_id=1, now=EVENTS_NOW, requests_out=f"{root}/next")
    return spark.read.parquet(f"{root}/next").drop("batch_id", "for_feed")


def stream_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages read as a stream whose offset is the last header-log entry handed out
    (T1). The first wave has one pull with no rows yet and lacks another one that sorts
    first; the second wave brings both, out of order, and the stream takes just them."""
    root = lake_root(spark)
    raw = A.events_raw(spark, sf_dir)
    # built once, landed in two waves
    pages = reliable_checkpoint(
        build_pages(raw, DA, ["pull_id"], "ingest_seq", A.ADAPTER_PAGE_SIZE).withColumnRenamed("pull_id", "pull"))
    headers = pages.groupBy("pull").agg(F.sum("n_rows").cast("bigint").alias("total_rows"))
    first, empty = headers.agg(F.min("pull"), F.max("pull")).first()
    out, ck = f"{root}/out", f"{root}/_checkpoint"
    early = ~F.col("pull").isin(first, empty)
    before = headers.where(F.col("pull") != first).withColumn(
        "total_rows", F.when(F.col("pull") == empty, F.lit(0).cast("bigint")).otherwise(F.col("total_rows")))
    for new_pages, known, append in ((pages.where(early), before, False), (pages.where(~early), headers, True)):
        write_page_folder(new_pages, known, f"{root}/pages", DA_FEED, append)
        q = (read_feed_stream(spark, {"root": f"{root}/pages", "feed": DA_FEED, "page_size": A.ADAPTER_PAGE_SIZE,
                                      "pages_per_partition": PAGES_PER_TASK})
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    recs = spark.read.parquet(out)
    return normalize_prices(recs, DA, keep=("pull", "start_row", "api_row")).withColumnRenamed("pull", "pull_id")


# Pages that a micro-batch of the limited cursor stream takes.
CURSOR_PAGES_PER_BATCH = 8


def stream_cursor_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header log handed out a few pages at a time (T1 with admission control): the
    same rows as without a limit, in several micro-batches."""
    root = lake_root(spark)
    pages = reliable_checkpoint(build_pages(A.events_raw(spark, sf_dir), DA, ["pull_id"], "ingest_seq", A.ADAPTER_PAGE_SIZE)
                                .withColumnRenamed("pull_id", "pull"))
    write_page_folder(pages, pages.groupBy("pull").agg(F.sum("n_rows").cast("bigint").alias("total_rows")), f"{root}/pages", DA_FEED)
    out, ck = f"{root}/out", f"{root}/_checkpoint"
    q = (read_feed_stream(spark, {"root": f"{root}/pages", "feed": DA_FEED, "page_size": A.ADAPTER_PAGE_SIZE,
                                  "pages_per_partition": PAGES_PER_TASK, "max_pages_per_batch": CURSOR_PAGES_PER_BATCH,
                                  "position": f"{ck}/feed-position"})
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    recs = spark.read.parquet(out)
    return normalize_prices(recs, DA, keep=("pull", "start_row", "api_row")).withColumnRenamed("pull", "pull_id")


# Files per micro-batch in the streaming keys, so that several micro-batches run.
STREAM_FILES_PER_TRIGGER = 16


def intake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows of the market days named by the merge requests: the day
    list is a partition filter on the intake (only those folders are read);
    provenance is read and dropped, as a merge does."""
    from lmplake.sources.intake import scan_intake
    root = lake_root(spark)
    land_intake(A.events_prices(spark, sf_dir), f"{root}/intake", DA)
    requested = P.coalesce_merge_requests(decode_messages(A.event_messages(spark, sf_dir)))
    days = [r[0] for r in requested.select("merge_date").distinct().collect()]  # bounded by the calendar
    landed = scan_intake(spark, f"{root}/intake", DA, days)
    return landed.drop("file_path", "file_modification_time")


def day_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event prices merged into a fresh day table (range-partitioned,
    sorted, zstd, one folder per day, dynamic overwrite) and read back."""
    table = f"{lake_root(spark)}/day"
    merge_into_day_table(spark, table, A.events_prices(spark, sf_dir).select(*PRICE_COLS), DA)
    return spark.read.parquet(table)


def intake_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings (existing rows, then new rows stamped as landing 1), each
    followed by a batch sweep of the files the ledger does not list yet."""
    root = lake_root(spark)
    existing, new = _existing_new(spark, sf_dir)
    for i, landing in enumerate((existing, stamp_ingest_seq(new, 1, "ingest_seq"))):
        land_intake(landing, f"{root}/intake", DA)
        sweep_intake(spark, f"{root}/intake", f"{root}/day", f"{root}/ledger", DA, batch_id=i)
    return spark.read.parquet(f"{root}/day")


def stream_day_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing rows merged in batch; new rows stamped as landing 1 (sequence
    = 1 << 32 | event id), landed as intake files and merged by a streaming
    query in several micro-batches. Same rows as the one-shot ``day_merge``."""
    root = lake_root(spark)
    existing, new = _existing_new(spark, sf_dir)
    new = stamp_ingest_seq(new, 1, "ingest_seq")
    table_dir, intake_dir = f"{root}/day", f"{root}/intake"
    merge_into_day_table(spark, table_dir, existing, DA)
    land_intake(new, intake_dir, DA)
    q = start_day_merge(spark, intake_dir, table_dir, f"{root}/_checkpoint/day", DA,
                        ledger_dir=f"{root}/ledger", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return spark.read.parquet(table_dir)


def stream_asset_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = lake_root(spark)
    assets = asset_dimension(spark, A.TEST_ASSETS)
    existing, new = _existing_new(spark, sf_dir)
    new = stamp_ingest_seq(new, 1, "ingest_seq")
    serving_dir, intake_dir = f"{root}/serving", f"{root}/intake"
    upsert_serving(spark, serving_dir, existing, assets, DA)
    land_intake(new, intake_dir, DA)
    q = start_serving_upsert(spark, intake_dir, serving_dir, f"{root}/_checkpoint/serving", DA, assets,
                             max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return spark.read.parquet(serving_dir)


def landing_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event prices landed by two streams with checkpoints of their own, two waves each: both count their batches
    from 0, the lake counts the landings on."""
    root = lake_root(spark)
    prices = A.events_prices(spark, sf_dir).select(*PRICE_COLS)
    for wave in range(4):
        name = "ab"[wave // 2]
        prices.where(F.col("ingest_seq") % 4 == wave).write.mode("append").parquet(f"{root}/rows-{name}")
        rows = spark.readStream.schema(prices.schema).parquet(f"{root}/rows-{name}")
        start_landing(rows, f"{root}/intake", f"{root}/_landings", f"{root}/_checkpoint/{name}", DA, "ingest_seq").awaitTermination()
    return spark.read.parquet(f"{root}/intake").withColumn("landing", F.col("landing").cast("bigint"))


def _land_mixed(spark, sf_dir, intake: str) -> None:
    """An intake of three writers: signed and unsigned 64-bit and signed 32-bit ids."""
    prices = A.events_prices(spark, sf_dir).select(*PRICE_COLS)
    for i, kind in enumerate(("int64", "uint64", "int32")):
        A.land_typed(prices.where(F.col("ingest_seq") % 3 == i), intake, kind, kind)


def intake_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An intake whose files differ in width and sign of their ids, in one scan."""
    from lmplake.sources.intake import scan_intake
    intake = f"{lake_root(spark)}/intake"
    _land_mixed(spark, sf_dir, intake)
    return scan_intake(spark, intake, DA).drop("file_path", "file_modification_time")


def stream_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same intake merged into a day table by the stream."""
    root = lake_root(spark)
    _land_mixed(spark, sf_dir, f"{root}/intake")
    start_day_merge(spark, f"{root}/intake", f"{root}/day", f"{root}/_checkpoint", DA,
                    max_files_per_trigger=STREAM_FILES_PER_TRIGGER).awaitTermination()
    return spark.read.parquet(f"{root}/day")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows (T6): a third of the rows arrives a micro-batch later than its neighbours, with revisions of another
    third; none is too late, and the revised prices win."""
    root = lake_root(spark)
    prices = A.events_prices(spark, sf_dir).select(*PRICE_COLS)
    third = F.col("ingest_seq") % 3
    revised = prices.where(third != 2).withColumn("dalmp", F.when(third == 1, F.col("dalmp") + 1).otherwise(F.col("dalmp")))
    for wave, rows in enumerate((prices.where(third != 0), revised), 1):
        land_intake(stamp_ingest_seq(rows, wave, "ingest_seq"), f"{root}/intake", DA, wave)
        start_day_merge(spark, f"{root}/intake", f"{root}/day", f"{root}/_checkpoint", DA).awaitTermination()
    return spark.read.parquet(f"{root}/day")


def _versioned_table(spark, sf_dir):
    """Existing rows, then new rows stamped as landing 1, merged into a versioned table."""
    table = f"{lake_root(spark)}/day"
    existing, new = _existing_new(spark, sf_dir)
    for rows in (existing, stamp_ingest_seq(new, 1, "ingest_seq")):
        merge_versioned(spark, table, rows, DA)
    return table


def node_set_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of each day of the versioned table, from its bitmaps."""
    return table_nodes(spark, _versioned_table(spark, sf_dir))


def node_set_carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes that the second merge carried over, by and-not of the bitmaps."""
    return table_carried_over(spark, _versioned_table(spark, sf_dir))


def node_set_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the asset nodes in the versioned table, on the days whose bitmaps have one."""
    return read_nodes(spark, _versioned_table(spark, sf_dir), DA, [n for n, _ in A.TEST_ASSETS])


def versioned_day_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versioned table read at both versions (K3)."""
    table = _versioned_table(spark, sf_dir)
    old, now = (read_versioned(spark, table, DA, version=v).withColumn("version", F.lit(v).cast("bigint")) for v in (1, 2))
    return old.unionByName(now)


def _merge_events(spark, sf_dir):
    """Merge requests and ends of merges in four waves: requests, more of them while merges run, the end of the merges
    of odd days, and requests again."""
    # all waves take them, and a wave's filter on the day would be pushed below the decode, which parses again for each mention
    asked = reliable_checkpoint(P.coalesce_merge_requests(decode_messages(A.event_messages(spark, sf_dir)))
                                .select("feed", "merge_date", "n_requests"))
    day = F.dayofmonth("merge_date")
    each = asked.select("feed", "merge_date", F.explode(F.sequence(F.lit(1).cast("bigint"), "n_requests")).alias("nth")).drop("nth") \
        .withColumn("what", F.lit(REQUESTED))
    first, second = each.where(day % 5 != 0), each.where(day % 3 == 0)
    ended = asked.where((day % 5 != 0) & (day % 2 == 1)).select("feed", "merge_date", F.lit(FINISHED).alias("what"))
    return [first, second, ended, each]


def stream_merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges that four waves of requests and ends of merges start, one wave a micro-batch (T5)."""
    root = lake_root(spark)
    for wave in _merge_events(spark, sf_dir):
        wave.write.mode("append").parquet(f"{root}/events")
        events = spark.readStream.schema("feed string, merge_date date, what string").parquet(f"{root}/events")
        start_merge_actions(events, f"{root}/actions", f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/actions").withColumn("batch_id", F.col("batch_id").cast("bigint"))


RELEASE_TIMES = ("2001-07-15 12:30:00", "2001-07-15 13:00:00", "2001-07-20 00:00:00")


def released_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of due requests, released at three times; the second release runs twice, as after a failure (K7)."""
    root = lake_root(spark)
    pull = F.concat_ws("/", "pull_id", F.col("pricedate").cast("string"))
    requests = next_requests_q(spark, sf_dir).withColumn("pull", pull).withColumn("batch_id", F.lit(0).cast("bigint"))
    requests.select("batch_id", "feed", "pull", "not_before", "message").write.parquet(f"{root}/requests")
    for release, now in ((0, 0), (1, 1), (1, 1), (2, 2)):
        P.release_requests(spark, f"{root}/requests", f"{root}/messages", f"{root}/released", RELEASE_TIMES[now], release)
    return spark.read.text(f"{root}/messages").select(F.col("value").alias("message"), F.col("release_id").cast("bigint").alias("release_id"))


def stream_due_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that arrive in three waves and go out by their timers, the clock at one of three times in each wave."""
    root = lake_root(spark)
    pull = F.concat_ws("/", "pull_id", F.col("pricedate").cast("string"))
    requests = reliable_checkpoint(next_requests_q(spark, sf_dir).select(
        F.lit(0).cast("bigint").alias("batch_id"), "feed", pull.alias("pull"), "not_before", "message", "pricedate"))
    for wave, now in enumerate(RELEASE_TIMES):
        requests.where(F.dayofmonth("pricedate") % 3 == wave).drop("pricedate", "batch_id").write.parquet(f"{root}/requests/batch_id={wave}")
        spark.sql(f"select TIMESTAMP '{now} UTC' as clock").write.mode("append").parquet(f"{root}/clock")
        clock = spark.readStream.schema("clock timestamp").parquet(f"{root}/clock")
        start_timed_release(request_stream(spark, f"{root}/requests"), clock, f"{root}/_checkpoint", f"{root}/messages/wave={wave}",
                            f"{root}/_landings").awaitTermination()
    return spark.read.text(f"{root}/messages").select(F.col("value").alias("message"), F.col("wave").cast("bigint").alias("wave"))


def gap_ranges_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gaps of each node as ranges of missing hours."""
    return Q.gap_ranges(A.events_prices(spark, sf_dir), ["node_id"], DA.step_minutes)


def refill_requests_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch messages for the gaps of the day-ahead and the five-minute feed, per node."""
    gaps = [Q.gap_ranges(A.events_prices(spark, sf_dir, name).withColumn("feed", F.lit(name)), ["feed", "node_id"], feed(name).step_minutes)
            for name in (DA_FEED, RT_VERIFIED_FEED)]
    return Q.refill_requests(gaps[0].unionByName(gaps[1]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_prices": normalize_prices_q,
    "scan_json_pages": scan_json_pages,
    "parse_timestamps": parse_timestamps,
    "quarantine_rows": quarantine_rows,
    "scan_json_files": scan_json_files,
    "overlapping_pulls": overlapping_pulls,
    "latest_wins": latest_wins_q,
    "first_day_filter": first_day_filter_q,
    "next_cursor": next_cursor_q,
    "page_plan": page_plan_q,
    "page_completeness": page_completeness_q,
    "request_windows": request_windows,
    "expected_at": expected_at_q,
    "request_delay": request_delay_q,
    "control_messages": control_messages,
    "pending_merges": pending_merges,
    "quarantined_messages": quarantined_messages,
    "stream_pending_merges": stream_pending_merges,
    "next_requests": next_requests_q,
    "due_requests": due_requests_q,
    "day_merge": day_merge,
    "carried_over_nodes": carried_over_nodes,
    "input_manifest": input_manifest,
    "unprocessed_inputs": unprocessed_inputs,
    "node_inventory": node_inventory,
    "node_day_lookup": node_day_lookup,
    "asset_lookup": asset_lookup_q,
    "asset_upsert": asset_upsert_q,
    "gap_report": gap_report,
    "gap_report_nodes": gap_report_nodes,
    "freshness": freshness,
    "day_completeness": day_completeness,
    "day_boundaries": day_boundaries,
    "save_targets": save_targets,
    "stream_cursor_limited": stream_cursor_limited,
    "feed_source_plan": feed_source_plan,
    "feed_source_read": feed_source_read,
    "list_files": list_files_q,
    "serving_rt": serving_rt,
    "land_intake": land_intake_q,
    "stream_cursor": stream_cursor,
    "fetch_cycle": fetch_cycle,
    "intake_scan": intake_scan,
    "day_layout": day_layout,
    "intake_sweep": intake_sweep,
    "stream_day_merge": stream_day_merge,
    "stream_asset_upsert": stream_asset_upsert,
    "landing_sequence": landing_sequence,
    "intake_mixed_types": intake_mixed_types,
    "stream_mixed_types": stream_mixed_types,
    "stream_late_rows": stream_late_rows,
    "stream_merge_actions": stream_merge_actions,
    "released_requests": released_requests,
    "stream_due_requests": stream_due_requests,
    "versioned_day_merge": versioned_day_merge,
    "node_set_inventory": node_set_inventory,
    "node_set_carried_over": node_set_carried_over,
    "node_set_lookup": node_set_lookup,
    "gap_ranges": gap_ranges_q,
    "refill_requests": refill_requests_q,
}
