"""Requests released by their own timers."""
import datetime as dt

import pytest

from lmplake.streaming.timers import _PROVIDER, request_stream, start_timed_release

UTC = dt.timezone.utc


def at(second, micro=0):
    return dt.datetime(2024, 1, 1, 0, 0, second, micro)


class Worker:
    """A request folder, a clock folder and the release stream between runs."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options, self.seen = spark, str(root), options, set()
        spark.createDataFrame([], "batch_id long, feed string, pull string, not_before timestamp_ntz, message string") \
            .write.parquet(f"{root}/requests")
        spark.createDataFrame([], "clock timestamp").write.parquet(f"{root}/clock")

    def ask(self, *requests):
        rows = [(0, "f", pull, due, message) for pull, due, message in requests]
        self.spark.createDataFrame(rows, "batch_id long, feed string, pull string, not_before timestamp_ntz, message string") \
            .coalesce(1).write.mode("append").parquet(f"{self.root}/requests")

    def run(self, now):
        """What a new start of the query releases with the clock at ``now``."""
        self.spark.createDataFrame([(now.replace(tzinfo=UTC),)], "clock timestamp").coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/clock")
        clock = self.spark.readStream.schema("clock timestamp").parquet(f"{self.root}/clock")
        start_timed_release(request_stream(self.spark, f"{self.root}/requests"), clock, f"{self.root}/ck", f"{self.root}/messages",
                            f"{self.root}/landings", **self.options).awaitTermination()
        rows = {(r.release_id, r.value) for r in self.spark.read.schema("value string, release_id long")
                .text(f"{self.root}/messages").collect()}
        new, self.seen = rows - self.seen, rows
        return sorted(v for _, v in new)


def test_requests_go_out_when_their_time_comes(spark, tmp_path):
    before = spark.conf.get(_PROVIDER, None)
    w = Worker(spark, tmp_path)
    w.ask(("a", at(10), "A"), ("b", at(20), "B"), ("c", None, "never"), ("d", at(20, 1), "D"), ("e", at(30), None))
    assert w.run(at(9, 999_999)) == []
    assert w.run(at(10)) == ["A"]
    w.ask(("late", at(5), "L"))
    assert w.run(at(20)) == ["B", "L"]
    assert w.run(at(20, 1_000)) == ["D"]
    assert w.run(at(40)) == [""]
    assert spark.conf.get(_PROVIDER, None) == before


def test_a_repeated_request_goes_out_once(spark, tmp_path):
    w = Worker(spark, tmp_path, remember=dt.timedelta(seconds=30))
    w.ask(("a", at(10), "A"), ("a", at(10), "A"), ("a", at(5), "earlier"))
    assert w.run(at(1)) == []
    w.ask(("a", at(2), "again, while it waits"))
    assert w.run(at(4)) == []
    assert w.run(at(6)) == ["earlier"]
    w.ask(("a", at(10), "A"))
    assert w.run(at(20)) == []
    assert w.run(at(50)) == []  # by now it is forgotten: 30 seconds after its time
    w.ask(("a", at(51), "new"))
    assert w.run(at(52)) == ["new"]


@pytest.mark.parametrize("zone", ["Asia/Tokyo"])
def test_timers_keep_utc_in_any_session_zone(spark, tmp_path, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        w = Worker(spark, tmp_path)
        w.ask(("a", at(10), "A"))
        assert w.run(at(9)) == []
        assert w.run(at(10)) == ["A"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
