"""Python Data Source: page planning from headers, batch and stream reads."""
import json

from pyspark.sql import functions as F

from lmplake.feeds import RT_VERIFIED_FEED
from lmplake.sources import feed_source as S
from lmplake.sources.feed_source import read_feed, read_feed_stream, register, write_page_folder


def _land(spark, root, pulls):
    pages, headers = [], []
    for pull, n in pulls:
        recs = [{"datetime_beginning_utc": f"2024-01-01T{pull[-2:]}:{(i % 12) * 5:02d}:00", "pnode_id": 100 + i,
                 "total_lmp_rt": i, "congestion_price_rt": 0.5, "marginal_loss_price_rt": None} for i in range(n)]
        for s in range(0, n, 4):
            pages.append((pull, s + 1, json.dumps(recs[s:s + 4])))
        headers.append((pull, n))
    write_page_folder(spark.createDataFrame(pages, "pull string, start_row bigint, page_text string"),
                      spark.createDataFrame(headers, "pull string, total_rows bigint"), root, RT_VERIFIED_FEED)


def test_batch_read_plans_one_partition_per_page(spark, tmp_path):
    root = str(tmp_path / "pages")
    _land(spark, root, [("20240101T05", 10), ("20240101T06", 4), ("20240101T07", 0)])
    register(spark)
    pages = (spark.read.format("lmplake_feed").option("root", root).option("feed", RT_VERIFIED_FEED)
             .option("page_size", 4).load())
    assert pages.rdd.getNumPartitions() == 4  # 3 pages + 1 page; the empty pull plans none
    rows = read_feed(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4}).collect()
    assert len(rows) == 14
    assert {r.total_lmp_rt for r in rows if r.pull == "20240101T05"} == {str(i) for i in range(10)}
    assert all(r.marginal_loss_price_rt is None for r in rows)


def test_stream_cursor_takes_new_pulls_only(spark, tmp_path):
    root = str(tmp_path / "pages")
    _land(spark, root, [("20240101T05", 6), ("20240101T06", 3)])
    register(spark)
    out = str(tmp_path / "out")
    ck = str(tmp_path / "ck")

    def run():
        q = (read_feed_stream(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4})
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 9
    run()  # nothing new: the offset did not move
    assert spark.read.parquet(out).count() == 9
    _land(spark, root, [("20240101T05", 6), ("20240101T06", 3), ("20240101T07", 5)])
    run()
    got = spark.read.parquet(out)
    assert got.count() == 14 and got.where(F.col("pull") == "20240101T07").count() == 5


def test_missing_page_fails_the_read_in_strict_mode(spark, tmp_path):
    import pytest
    root = str(tmp_path / "pages")
    _land(spark, root, [("20240101T05", 10)])
    import shutil
    shutil.rmtree(f"{root}/feed={RT_VERIFIED_FEED}/pull=20240101T05/start_row=5")
    opts = {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4}
    with pytest.raises(Exception, match="header promised"):
        read_feed(spark, opts).collect()
    assert read_feed(spark, {**opts, "strict": "false"}).count() == 6


def test_api_order_decides_among_new_rows(spark, tmp_path):
    from lmplake.operators.normalize import normalize_prices
    from lmplake.feeds import feed
    from lmplake.sinks.lake import merge_into_day_table, stamp_ingest_seq
    spec = feed(RT_VERIFIED_FEED)
    root = str(tmp_path / "pages")
    recs = [{"datetime_beginning_utc": "2024-01-01T05:00:00", "pnode_id": 7, "total_lmp_rt": v,
             "congestion_price_rt": 0, "marginal_loss_price_rt": 0} for v in (1, 2, 3, 4, 5)]
    pages = [("20240101T05", 1, json.dumps(recs[:4])), ("20240101T05", 5, json.dumps(recs[4:]))]
    write_page_folder(spark.createDataFrame(pages, "pull string, start_row bigint, page_text string"),
                      spark.createDataFrame([("20240101T05", 5)], "pull string, total_rows bigint"), root,
                      RT_VERIFIED_FEED)
    raw = read_feed(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4})
    prices = stamp_ingest_seq(normalize_prices(raw, spec, keep=("api_row",)), landing_id=3)
    table = str(tmp_path / "day")
    merge_into_day_table(spark, table, prices, spec)
    got = spark.read.parquet(table).collect()
    assert [(r.rtlmp, r.ingest_seq) for r in got] == [(5.0, (3 << 32) + 5)]


def test_pull_filter_is_pushed_to_the_source(spark, tmp_path):
    root = str(tmp_path / "pages")
    _land(spark, root, [("20240101T05", 10), ("20240101T06", 4), ("20240101T07", 8)])
    register(spark)
    old = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pages = (spark.read.format("lmplake_feed").option("root", root).option("feed", RT_VERIFIED_FEED)
                 .option("page_size", 4).option("pushdown", "true").load()
                 .where(F.col("pull").isin("20240101T05", "20240101T07")))
        assert pages.rdd.getNumPartitions() == 5  # 3 + 2 pages; the other pull is not planned
        assert read_feed(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4, "pushdown": "true"}) \
            .where(F.col("pull").isin("20240101T05", "20240101T07")).count() == 18
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", old)


def test_pages_grouped_per_task(spark, tmp_path):
    root = str(tmp_path / "pages")
    _land(spark, root, [("20240101T05", 10), ("20240101T06", 4)])
    register(spark)
    pages = (spark.read.format("lmplake_feed").option("root", root).option("feed", RT_VERIFIED_FEED)
             .option("page_size", 4).option("pages_per_partition", 2).load())
    assert pages.rdd.getNumPartitions() == 3  # pull 05: pages (1,5) + (9); pull 06: (1)
    df = read_feed(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4, "pages_per_partition": 2})
    assert sorted(r.api_row for r in df.where(F.col("pull") == "20240101T05").collect()) == list(range(1, 11))


def test_a_pull_without_rows_is_taken_when_it_has_some_and_late_pulls_too(spark, tmp_path):
    root, out, ck = (str(tmp_path / x) for x in ("pages", "out", "ck"))
    register(spark)

    def run():
        (read_feed_stream(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4})
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start().awaitTermination())
        return sorted((r["pull"], r["count"]) for r in spark.read.parquet(out).groupBy("pull").count().collect())

    _land(spark, root, [("20240101T06", 5), ("20240101T07", 0)])
    assert run() == [("20240101T06", 5)]
    _land(spark, root, [("20240101T05", 3)])  # arrives late, sorts first
    assert run() == [("20240101T05", 3), ("20240101T06", 5)]
    _land(spark, root, [("20240101T07", 2)])
    assert run() == [("20240101T05", 3), ("20240101T06", 5), ("20240101T07", 2)]
    assert run() == [("20240101T05", 3), ("20240101T06", 5), ("20240101T07", 2)]


def test_a_pull_without_a_header_fails(spark, tmp_path):
    import pytest
    root = str(tmp_path / "pages")
    _land(spark, root, [("20240101T05", 3)])
    with pytest.raises(Exception, match="no row-count header"):
        read_feed(spark, {"root": root, "feed": RT_VERIFIED_FEED, "pulls": "20240101T05,20240101T09"}).collect()


def test_pull_keys_may_hold_commas(spark, tmp_path):
    root = str(tmp_path / "pages")
    _land(spark, root, [("a,b05", 3), ("c06", 2)])
    assert read_feed(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4, "pulls": json.dumps(["a,b05"])}).count() == 3


def _log(spark, root, headers, feed_name=RT_VERIFIED_FEED):
    write_page_folder(spark.createDataFrame([], "pull string, start_row bigint, page_text string"),
                      spark.createDataFrame(headers, "pull string, total_rows bigint"), root, feed_name, append=True)


def test_headers_of_few_pulls_open_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ENTRIES", 8)
    monkeypatch.setattr(S, "SNAPSHOT_EVERY", 4)
    root, want = str(tmp_path / "pages"), {}
    opened = []
    for wave in range(11):
        changed = {f"p{i:03d}": wave * 1000 + i for i in range(wave * 20, wave * 20 + 20)} | {"p000": wave}
        want |= changed
        _log(spark, root, sorted(changed.items()))
        t = S.PageFolderTransport({"root": root})
        assert t.headers(RT_VERIFIED_FEED) == want
        assert {r["pull"]: r["total_rows"] for r in t.headers_frame(spark, RT_VERIFIED_FEED).collect()} == want
        t = S.PageFolderTransport({"root": root})
        assert t.headers_of(RT_VERIFIED_FEED, ["p000", "p013", "none"]) == {"p000": wave, "p013": 13}
        opened.append(t.opened)
    # three pulls: at most three buckets of the snapshot and of the three landings that may be behind it
    assert max(opened) <= 3 * 4 and opened[-1] <= 3 * 4
    assert S.PageFolderTransport({"root": root}).snapshot(RT_VERIFIED_FEED)[0] == "00000008"
    assert S.PageFolderTransport({"root": root}).log_between(RT_VERIFIED_FEED, "", "00000002") \
        == {f"p{i:03d}": (i // 20) * 1000 + i for i in range(1, 40)} | {"p000": 1}


def test_a_snapshot_that_died_is_not_read(spark, tmp_path):
    root = str(tmp_path / "pages")
    _log(spark, root, [("a", 1), ("b", 2)])
    assert S.compact_headers(spark, root, RT_VERIFIED_FEED) == "00000001"
    _log(spark, root, [("a", 7)])
    died = tmp_path / "pages" / "_headers" / "_snapshots" / RT_VERIFIED_FEED / "upto=00000002" / "bucket=0"
    died.mkdir(parents=True)
    (died / "part-0.json").write_text('{"feed":"x","pull":"a","total_rows":99}\n')
    t = S.PageFolderTransport({"root": root})
    assert t.headers(RT_VERIFIED_FEED) == {"a": 7, "b": 2} and t.log_end(RT_VERIFIED_FEED) == "00000002"
    assert S.compact_headers(spark, root, RT_VERIFIED_FEED) == "00000002"
    assert S.PageFolderTransport({"root": root}).headers_of(RT_VERIFIED_FEED, ["a"]) == {"a": 7}


def test_a_log_without_buckets_is_read(spark, tmp_path):
    old = tmp_path / "pages" / "_headers" / "landing=00000001"
    old.mkdir(parents=True)
    (old / "part-0.json").write_text("".join(json.dumps({"feed": RT_VERIFIED_FEED, "pull": p, "total_rows": n}) + "\n"
                                             for p, n in (("a", 1), ("b", 2))))
    (old / "_COMPLETE").touch()
    root = str(tmp_path / "pages")
    _log(spark, root, [("a", 1), ("b", 3)])
    t = S.PageFolderTransport({"root": root})
    assert t.headers(RT_VERIFIED_FEED) == {"a": 1, "b": 3} and t.log_between(RT_VERIFIED_FEED, "00000001", "00000002") == {"b": 3}


def _limited(spark, tmp_path, limit):
    """Run the limited stream until it has caught up; the pulls of each micro-batch that it ran."""
    root, out, ck = (str(tmp_path / x) for x in ("pages", "out", "ck"))
    batches = []
    q = (read_feed_stream(spark, {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4, "max_pages_per_batch": limit,
                                  "position": f"{ck}/feed-position"})
         .writeStream.foreachBatch(lambda df, n: batches.append(
             sorted((r["pull"], r["count"]) for r in df.groupBy("pull").count().collect())))
         .option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return batches


def test_a_limited_stream_takes_bounded_batches_and_goes_on_after_a_restart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ENTRIES", 3)
    register(spark)
    root = str(tmp_path / "pages")
    sizes = {f"20240101T{h:02d}": n for h, n in enumerate([4, 5, 1, 0, 12, 3, 30, 8, 2])}
    _land(spark, root, sorted(sizes.items()))
    got = _limited(spark, tmp_path, 3)
    pages = [sum(-(-n // 4) for _, n in b) for b in got]
    assert sorted(p for b in got for p in b) == sorted((p, n) for p, n in sizes.items() if n)
    # 30 rows are 8 pages, more than the limit: they stand alone
    assert all(n <= 3 or (n == 8 and len(b) == 1) for n, b in zip(pages, got)) and len(got) >= 6
    assert _limited(spark, tmp_path, 3) == []  # nothing new after a restart
    _land(spark, root, [("20240101T03", 6), ("20240101T20", 9)])
    assert sorted(p for b in _limited(spark, tmp_path, 3) for p in b) == [("20240101T03", 6), ("20240101T20", 9)]


def test_a_replayed_offset_plans_the_same_pages_and_a_lost_position_fails(spark, tmp_path):
    import pytest
    root = str(tmp_path / "pages")
    _log(spark, root, [(f"p{i}", 5) for i in range(6)])
    options = {"root": root, "feed": RT_VERIFIED_FEED, "page_size": 4, "max_pages_per_batch": 4, "position": str(tmp_path / "at")}

    def plan(reader, start, end):
        return [(p.pull, p.pages) for p in reader.partitions(start, end)]

    one = S.FeedCursorStreamReader(options)
    end = one.latestOffset()
    assert one.latestOffset() == end  # not planned yet
    first = plan(one, one.initialOffset(), end)
    assert len(first) == 4
    again = S.FeedCursorStreamReader(options)  # a restart that replays the batch
    assert plan(again, again.initialOffset(), end) == first
    nxt = again.latestOffset()
    second = plan(again, end, nxt)
    third = plan(again, nxt, again.latestOffset())
    assert sorted({p for p, _ in first + second + third}) == [f"p{i}" for i in range(6)]
    assert again.latestOffset() == {"log": "00000001"}
    lost = S.FeedCursorStreamReader({**options, "position": str(tmp_path / "elsewhere")})
    with pytest.raises(ValueError, match="behind its checkpoint"):
        lost.partitions(nxt, lost.latestOffset())
    with pytest.raises(ValueError, match="position"):
        S.FeedCursorStreamReader({**options, "position": ""})
