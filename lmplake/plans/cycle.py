"""One fetch cycle of a feed, end to end (the worker's main loop as a job).

requests (feed, pull, begin_utc, queue_next)
  -> pages read through the feed source (one task per page)
  -> typed prices (strict parse) -> first market day of each pull
  -> total merge order stamped (landing id, pull by its begin, row in pull)
  -> landed in the intake, upserted into the serving table
  -> next requests (continue at max + step, or retry an empty pull)

The typed rows are checkpointed once (shared folder) right after the fetch
and everything downstream reads that, so each page is fetched once even
though the first-day filter and three outputs use it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmplake.feeds import feed
from lmplake.operators.normalize import normalize_prices
from lmplake.operators.pulls import first_day_filter, next_requests
from lmplake.sinks.lake import land_intake, order_pulls, serving_table_path, stamp_ingest_seq, upsert_serving
from lmplake.session import reliable_checkpoint
from lmplake.sources.feed_source import read_feed


def run_fetch_cycle(spark: SparkSession, requests: DataFrame, feed_name: str, source_options: dict,
                    intake_dir: str, serving_root: str, assets: DataFrame, landing_id: int, now,
                    requests_out: str | None = None, quarantine_dir: str | None = None) -> DataFrame:
    """Run one cycle for the ``requests`` (``feed, pull, begin_utc,
    queue_next``) of one feed and return the next requests (also written to
    ``requests_out`` when given).

    ``source_options`` configure the feed source (``root`` or ``transport``,
    ``page_size``, ``pages_per_partition``); pulled rows land in
    ``intake_dir`` stamped with ``landing_id`` (grow it with every cycle), known
    ``assets`` are upserted into ``serving_root/<feed's serving target>``, and
    ``now`` prices the next requests' delays.

    Pulls of one cycle may overlap: rows of the pull that begins later win. Everything
    that is written goes to folders of this landing and is replaced whole, so a cycle
    that is run again after a failure leaves what one run would have left. Rows without
    a time or a node are no prices: they go to ``quarantine_dir`` (default: beside the
    intake) and are not landed."""
    spec = feed(feed_name)
    reqs = requests.where(F.col("feed") == feed_name).select("feed", "pull", "begin_utc", "queue_next")
    # the pull keys of this cycle become the source's partition plan; one key
    # per request message, so the list is as long as the cycle's queue batch
    pulls = sorted(r[0] for r in reqs.select("pull").distinct().collect())
    raw = read_feed(spark, {**source_options, "feed": feed_name, "pulls": json.dumps(pulls)}) if pulls else None
    if raw is None:
        pulled = spark.createDataFrame([], "pull string, utcbegin timestamp_ntz")
    else:
        # checkpointed right after the fetch: the first-day filter reads its
        # input twice and three sinks follow, but each page is fetched once
        typed = reliable_checkpoint(normalize_prices(raw, spec, keep=("pull", "api_row")))
        good = F.col("utcbegin").isNotNull() & F.col("node_id").isNotNull()
        bad_dir = quarantine_dir or f"{intake_dir.rstrip('/')}_quarantine"
        typed.where(~good).withColumn("landing", F.lit(int(landing_id)).cast("bigint")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("landing").parquet(bad_dir)
        rows = order_pulls(first_day_filter(typed.where(good), ["pull"]), reqs)
        pulled = stamp_ingest_seq(rows, landing_id, "cycle_row")
        land_intake(pulled, intake_dir, spec, landing_id)
        upsert_serving(spark, serving_table_path(serving_root, spec), pulled, assets, spec)
    nxt = next_requests(reqs, pulled.withColumn("feed", F.lit(feed_name)).select("feed", "pull", "utcbegin"),
                        ["feed", "pull"], now)
    if requests_out:
        nxt.withColumn("batch_id", F.lit(int(landing_id)).cast("bigint")).withColumn("for_feed", F.lit(feed_name)) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "for_feed") \
            .parquet(requests_out)
    return nxt
