"""Driver tables -> feed-shaped inputs (FIXTURES §3).

The test data has no price feeds, so two tables stand in for them:

* ``events`` as an hourly feed: node = ``user_id``, pull = ``event_type``,
  interval = ``ts`` floored to the feed step, prices from ``value``,
  ingest order = ``event_id``;
* ``orders`` as an hourly feed whose midnights span 1995-2001 and so both
  New York UTC offsets: node = ``o_custkey``, pull = ``o_orderpriority``,
  interval = ``o_orderdate``, prices from ``o_totalprice``, ingest order =
  ``o_orderkey``.

Every adapter reads the whole table; nothing is sampled or capped. Raw
fields are produced as the API would send them (text), so the normal
parsing path runs on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.feeds import DA_FEED, RAW_NODE_FIELD, RAW_TIME_FIELD, RT_UNVERIFIED_FEED, RT_VERIFIED_FEED, feed
from lmplake.functions import messages as MSG
from lmplake.functions.time_cols import floor_to_step, hour_ending, market_date, market_local, market_midnight_utc, \
    pull_key, raw_time_text
from lmplake.operators.normalize import normalize_prices

# Test fixture values: rows per page in the adapters (so that several pages
# exist at small scale), the stand-in asset labels, and the event type ->
# feed mapping used for control messages and request windows.
ADAPTER_PAGE_SIZE = 500
TEST_ASSETS = ((8, "fern"), (46, "camden"), (7, "dom"))
EVENT_TYPE_FEED = {
    "click": DA_FEED,
    "view": RT_VERIFIED_FEED,
    "purchase": RT_UNVERIFIED_FEED,
    "signup": "merge",
    "error": "unknown",
}
KEEP = ("pull_id", "ingest_seq")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_prices(spec_name: str, price: Column) -> list[Column]:
    lmp, mcc, mcl = feed(spec_name).price_fields
    return [
        price.cast("string").alias(lmp),
        (price / F.lit(4)).cast("string").alias(mcc),
        (-price / F.lit(8)).cast("string").alias(mcl),
    ]


def events_raw(spark: SparkSession, sf_dir: str, feed_name: str = DA_FEED) -> DataFrame:
    """Raw page records of one feed built from ``events``."""
    spec = feed(feed_name)
    ev = table(spark, sf_dir, "events")
    t = floor_to_step("ts", spec.step_minutes)
    return ev.select(
        F.col("event_type").alias("pull_id"),
        F.col("event_id").alias("ingest_seq"),
        raw_time_text(t).alias(RAW_TIME_FIELD),
        F.col("user_id").cast("string").alias(RAW_NODE_FIELD),
        *_raw_prices(feed_name, F.col("value")),
    )


def events_raw_dirty(spark: SparkSession, sf_dir: str, feed_name: str = DA_FEED) -> DataFrame:
    """``events_raw`` with records that are wrong in one or more fields: every 97th time,
    89th node and 83rd price (by event id) is no time, no id and no number."""
    seq = F.col("ingest_seq")
    price = feed(feed_name).price_fields[0]
    return events_raw(spark, sf_dir, feed_name).withColumns({
        RAW_TIME_FIELD: F.when(seq % 97 == 0, F.lit("not a time")).otherwise(F.col(RAW_TIME_FIELD)),
        RAW_NODE_FIELD: F.when(seq % 89 == 0, F.lit("node-x")).otherwise(F.col(RAW_NODE_FIELD)),
        price: F.when(seq % 83 == 0, F.lit("n/a")).otherwise(F.col(price)),
    })


def overlapping_pulls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows, requests) of one cycle whose pulls overlap: a pull for each UTC day, and one
    from each noon that holds the afternoon's rows again, 1000 dearer."""
    day = F.date_trunc("day", F.col("utcbegin")).cast("timestamp_ntz")
    rows = events_prices(spark, sf_dir).withColumn("begin_utc", day).withColumnRenamed("ingest_seq", "api_row")
    noon = rows.where(F.hour("utcbegin") >= 12).withColumns({
        "begin_utc": F.timestamp_add("HOUR", F.lit(12), F.col("begin_utc")), "dalmp": F.col("dalmp") + 1000})
    both = rows.unionByName(noon).withColumn("pull", pull_key("begin_utc"))
    return both, both.select("pull", "begin_utc").distinct()


def boundary_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_prices`` with a third of the rows moved to the first hour of their market day
    and a third to the last one (by order key)."""
    p = orders_prices(spark, sf_dir)
    last = F.timestamp_add("HOUR", F.lit(-1), market_midnight_utc(F.date_add("pricedate", 1)))
    t = F.when(F.col("ingest_seq") % 3 == 0, market_midnight_utc("pricedate")) \
        .when(F.col("ingest_seq") % 3 == 1, last).otherwise(F.col("utcbegin"))
    return p.withColumn("utcbegin", t).withColumn("hour", hour_ending("utcbegin"))


def orders_raw(spark: SparkSession, sf_dir: str, feed_name: str = DA_FEED) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("pull_id"),
        F.col("o_orderkey").alias("ingest_seq"),
        raw_time_text("o_orderdate").alias(RAW_TIME_FIELD),
        F.col("o_custkey").cast("string").alias(RAW_NODE_FIELD),
        *_raw_prices(feed_name, F.col("o_totalprice")),
    )


def events_prices(spark: SparkSession, sf_dir: str, feed_name: str = DA_FEED) -> DataFrame:
    return normalize_prices(events_raw(spark, sf_dir, feed_name), feed(feed_name), KEEP)


def orders_prices(spark: SparkSession, sf_dir: str, feed_name: str = DA_FEED) -> DataFrame:
    return normalize_prices(orders_raw(spark, sf_dir, feed_name), feed(feed_name), KEEP)


def arrival_batch(seq: str = "ingest_seq") -> Column:
    """Stand-in arrival batch: even sequence numbers were merged earlier
    (the existing day table), odd ones arrive now. Every row is in one of
    the two batches."""
    return (F.col(seq) % F.lit(2)).cast("int")


def with_intake_file(prices: DataFrame, feed_name: str = DA_FEED) -> DataFrame:
    """Stand-in landing file per (pull, UTC day, arrival batch)."""
    path = F.concat(
        F.lit(f"{feed_name}/_input/"), F.col("pull_id"), F.lit("/"),
        F.to_date("utcbegin").cast("string"), F.lit("/batch"), arrival_batch().cast("string"), F.lit(".parquet"),
    )
    return prices.withColumn("file_path", path)


def _offset_text(utc: Column) -> Column:
    """UTC offset of New York at ``utc`` as '+HHMM'/'-HHMM'."""
    mins = F.timestamp_diff("MINUTE", utc, market_local(utc))
    sign = F.when(mins < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(mins)
    return F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"),
                    F.lpad((a % 60).cast("string"), 2, "0"))


def event_messages(spark: SparkSession, sf_dir: str, bad_days: bool = False, envelopes: bool = False) -> DataFrame:
    """One control message per event: fetch messages for three feeds with a
    New York offset begin time, merge messages, and messages naming an
    unknown feed; every third one quoted with escaped inner quotes.
    ``bad_days`` gives every fifth merge message a day that doesn't exist;
    ``envelopes`` puts every second message into a queue envelope."""
    ev = table(spark, sf_dir, "events")
    begin = floor_to_step("ts", 5)
    local_text = raw_time_text(market_local(begin))
    k = F.get_json_object("props", "$.k").try_cast("int")
    target = F.lit(None).cast("string")
    for et, fd in EVENT_TYPE_FEED.items():
        target = F.when(F.col("event_type") == et, F.lit(fd)).otherwise(target)
    is_merge = F.col("_target") == "merge"
    # One to_json per message: fields of the other kind are NULL and omitted.
    plain = F.to_json(F.struct(
        F.when(~is_merge, F.concat(local_text, _offset_text(begin))).alias(MSG.BEGIN_FIELD),
        F.when(~is_merge, F.col("_target")).alias(MSG.FEED_FIELD),
        F.when(~is_merge, k % 2 == 0).alias(MSG.NEXT_FIELD),
        F.when(is_merge, F.when(F.lit(bad_days) & (k % 5 == 0), F.lit("2024-13-40"))
               .otherwise(market_date(begin).cast("string"))).alias(MSG.DATE_FIELD),
        F.when(is_merge, F.lit(RT_VERIFIED_FEED)).alias(MSG.ENDPOINT_FIELD),
    ))
    wrap = k % 3 == 0
    quote = F.when(wrap, F.lit('"')).otherwise(F.lit(""))
    escaped = F.replace(plain, F.lit('"'), F.when(wrap, F.lit('\\"')).otherwise(F.lit('"')))
    out = ev.withColumn("_target", target).select(
        F.col("event_id").alias("ingest_seq"),
        F.concat(quote, escaped, quote).alias("value"),
    )
    if envelopes:
        wrapped = F.to_json(F.struct(F.create_map(F.lit("msg"), F.col("value")).alias(MSG.ENVELOPE_DATA),
                                     F.lit("x").alias("Metadata")))
        out = out.withColumn("value", F.when(F.col("ingest_seq") % 2 == 0, wrapped).otherwise(F.col("value")))
    return out


__all__ = [
    "ADAPTER_PAGE_SIZE", "TEST_ASSETS", "EVENT_TYPE_FEED", "KEEP", "table", "events_raw", "orders_raw",
    "events_prices", "orders_prices", "arrival_batch", "with_intake_file", "event_messages",
]


def land_typed(prices: DataFrame, intake_dir: str, node_type: str, name: str) -> None:
    """Fixture: land rows as another writer does, in files whose ``node_id`` has the given Arrow type (Spark
    itself writes no unsigned integers). Files go straight to the day folders, written by tasks."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    from lmplake.session import ship_package
    from lmplake.sources.paths import fs_for

    ship_package(prices.sparkSession)

    def write(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        n = 0
        for i, b in enumerate(batches):
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            at = t.schema.get_field_index("node_id")
            t = t.set_column(at, "node_id", t.column(at).cast(getattr(pa, node_type)()))
            fs, path = fs_for(intake_dir)
            ds.write_dataset(t, path, filesystem=fs, format="parquet", existing_data_behavior="overwrite_or_ignore",
                             partitioning=ds.partitioning(pa.schema([("pricedate", pa.date32())]), flavor="hive"),
                             basename_template=f"{name}-{part}-{i}-{{i}}.parquet")
            n += b.num_rows
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    prices.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
