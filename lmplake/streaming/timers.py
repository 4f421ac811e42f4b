"""Requests that wait for their time under a timer of their own.

A work item that isn't due yet is keyed state with one timer at its ``not_before``: the state store wakes
the items whose time has come, and no release reads the table of all requests again. Time is the watermark of a second
stream, the clock: in production a rate source (``wall_clock``), in tests rows of fixed instants. State is spread
over the shuffle partitions by request and holds what waits, so it grows with the open requests, not with all there ever were.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from lmplake.session import ship_package
from lmplake.sinks.landings import claim_landing, query_name

REQUEST_KEY = ["batch_id", "feed", "pull"]
RELEASED = "batch_id long, feed string, pull string, message string"
REMEMBER = dt.timedelta(days=7)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Waiting(StatefulProcessor):
    """One request: waiting until its timer, then remembered for a while so that a copy of it isn't released again."""

    def __init__(self, remember_ms: int):
        self.remember_ms = remember_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.request = handle.getValueState("request", "message string, released boolean")

    def handleInputRows(self, key, rows, timerValues):
        first = min(((r.due_ms, r.message or "") for r in rows), default=None)
        if first is not None and not self.request.exists():
            self.request.update((first[1], False))
            self.handle.registerTimer(first[0])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        message, released = self.request.get()
        if released:
            self.request.clear()
            return
        self.request.update(("", True))
        self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.remember_ms)
        yield Row(batch_id=key[0], feed=key[1], pull=key[2], message=message)

    def close(self) -> None:
        pass


def wall_clock(spark: SparkSession) -> DataFrame:
    """The machine's time, once a second, as a clock stream."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias("clock"))


def request_stream(spark: SparkSession, requests_dir: str) -> DataFrame:
    """The request folders that fetch cycles write, as a stream."""
    return spark.readStream.schema("batch_id long, feed string, pull string, not_before timestamp_ntz, message string") \
        .parquet(requests_dir)


def release_when_due(requests: DataFrame, clock: DataFrame, remember: dt.timedelta = REMEMBER) -> DataFrame:
    """Each request (batch_id, feed, pull, not_before in UTC, message) once, when the clock (column ``clock``, a
    timestamp) has reached its ``not_before``; in whole milliseconds, never early.

    A request that arrives after its time goes out at once. One that arrives again (a repeated batch writes its
    requests anew) is known while it waits and for ``remember`` after its release; of copies that arrive together the earliest
    counts. Without ``not_before`` a request is never due and isn't kept. Instants before 1970 count as 1970."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("not_before"))
    asked = requests.where("not_before is not null").select(
        *REQUEST_KEY, "message", F.greatest(F.ceil(micros / 1000), F.lit(1)).cast("bigint").alias("due_ms"),
        F.lit(None).cast("timestamp").alias("clock"))
    ticks = clock.select(*(F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in asked.columns[:-1]), "clock")
    # requests have no event time of their own, so none is late. The filter names the clock alone: Catalyst
    # moves any other filter below the watermark, which would lose the ticks
    return asked.unionByName(ticks).withWatermark("clock", "0 seconds").where("clock is null") \
        .groupBy(*REQUEST_KEY).transformWithState(
            Waiting(int(remember / dt.timedelta(milliseconds=1))), RELEASED, "append", "EventTime")


@contextmanager
def _timer_store(spark: SparkSession):
    """Timers need the RocksDB store. A query takes the setting when it starts; the session gets its own one back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def start_timed_release(requests: DataFrame, clock: DataFrame, checkpoint: str, message_dir: str, landings_dir: str,
                        remember: dt.timedelta = REMEMBER, available_now: bool = True, processing_time: str = "10 seconds",
                        after: Callable[[DataFrame, int], None] | None = None):
    """``release_when_due`` into the folder the control stream reads: ``message_dir/release_id=N`` with a number claimed
    in the lake (``landings_dir``) for each micro-batch, so a repeated batch replaces its own folder and a new checkpoint
    doesn't take an older one's. ``after(released, N)`` is called with what the folder holds."""
    spark = requests.sparkSession
    ship_package(spark)

    def put(df: DataFrame, batch_id: int) -> None:
        number = claim_landing(spark, landings_dir, f"{query_name(spark, checkpoint)}/{batch_id}")
        folder = f"{message_dir.rstrip('/')}/release_id={number}"
        df.select(F.col("message").alias("value")).write.mode("overwrite").text(folder)
        if after is not None:
            after(spark.read.schema("value string").text(folder), number)

    w = release_when_due(requests, clock, remember).writeStream.outputMode("append").foreachBatch(put) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    with _timer_store(spark):
        return w.start()
