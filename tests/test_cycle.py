"""A whole fetch cycle: pages -> typed -> first day -> intake + serving -> next requests."""
import datetime as dt
import json

from lmplake.feeds import DA_FEED
from lmplake.operators.serve import asset_dimension
from lmplake.plans.cycle import run_fetch_cycle
from lmplake.sources.feed_source import write_page_folder


def test_fetch_cycle(spark, tmp_path):
    root = str(tmp_path / "pages")
    recs = []
    for h in range(25):  # 05:00 UTC Jan 1 .. 05:00 UTC Jan 2 (the last one is the next New York day)
        t = dt.datetime(2024, 1, 1, 5) + dt.timedelta(hours=h)
        for node in (2156110049, 99):
            recs.append({"datetime_beginning_utc": t.strftime("%Y-%m-%dT%H:%M:%S"), "pnode_id": node,
                         "total_lmp_da": h, "congestion_price_da": 1, "marginal_loss_price_da": 0})
    pages = [("A", s + 1, json.dumps(recs[s:s + 20])) for s in range(0, len(recs), 20)]
    write_page_folder(spark.createDataFrame(pages, "pull string, start_row bigint, page_text string"),
                      spark.createDataFrame([("A", len(recs)), ("B", 0)], "pull string, total_rows bigint"),
                      root, DA_FEED)
    requests = spark.createDataFrame([
        (DA_FEED, "A", dt.datetime(2024, 1, 1, 5), True),
        (DA_FEED, "B", dt.datetime(2024, 1, 3, 5), True),
    ], "feed string, pull string, begin_utc timestamp_ntz, queue_next boolean")
    out = run_fetch_cycle(spark, requests, DA_FEED, {"root": root, "page_size": 20},
                          str(tmp_path / "intake"), str(tmp_path / "serving"), asset_dimension(spark),
                          landing_id=1, now="2024-01-01 00:00:00", requests_out=str(tmp_path / "next"))
    nxt = {r.pull: r for r in out.collect()}
    assert nxt["A"].n_rows == 48 and nxt["A"].next_begin_utc == dt.datetime(2024, 1, 2, 5)
    assert nxt["A"].delay_secs == 15 * 3600  # expected 14 h before the next begin
    assert nxt["B"].n_rows == 0 and nxt["B"].next_begin_utc == dt.datetime(2024, 1, 3, 5)
    intake = spark.read.parquet(str(tmp_path / "intake"))
    assert intake.count() == 48 and {r.pricedate for r in intake.select("pricedate").distinct().collect()} == {
        dt.date(2024, 1, 1)}
    serving = spark.read.parquet(str(tmp_path / "serving" / "da"))
    assert serving.count() == 24 and {r.node for r in serving.select("node").distinct().collect()} == {"fern"}
    assert spark.read.parquet(str(tmp_path / "next")).count() == 2


def _requests(spark, rows):
    return spark.createDataFrame(rows, "feed string, pull string, begin_utc timestamp_ntz, queue_next boolean")


def _record(t, node, price, feed="da"):
    return {"datetime_beginning_utc": t, "pnode_id": node, f"total_lmp_{feed}": price, f"congestion_price_{feed}": 1,
            f"marginal_loss_price_{feed}": 0}


def test_the_later_pull_wins_where_pulls_overlap(spark, tmp_path):
    from lmplake.feeds import RT_VERIFIED_FEED, feed
    from lmplake.sinks.lake import merge_into_day_table
    from lmplake.sources.intake import scan_intake
    root, spec = str(tmp_path / "pages"), feed(RT_VERIFIED_FEED)
    old = [_record(f"2024-01-10T15:0{m}:00", 7, 100, "rt") for m in (0, 5)]
    new = [_record(f"2024-01-10T15:{m}:00", 7, 200, "rt") for m in ("05", "10")]
    write_page_folder(
        spark.createDataFrame([("a", 1, json.dumps(new)), ("b", 1, json.dumps(old))], "pull string, start_row bigint, page_text string"),
        spark.createDataFrame([("a", 2), ("b", 2)], "pull string, total_rows bigint"), root, RT_VERIFIED_FEED)
    reqs = _requests(spark, [(RT_VERIFIED_FEED, "a", dt.datetime(2024, 1, 10, 15, 5), True),
                             (RT_VERIFIED_FEED, "b", dt.datetime(2024, 1, 10, 15, 0), True)])
    run_fetch_cycle(spark, reqs, RT_VERIFIED_FEED, {"root": root}, str(tmp_path / "intake"), str(tmp_path / "serving"),
                    asset_dimension(spark), landing_id=3, now="2024-01-11 00:00:00")
    for policy in ("arrival", "sequence"):
        table = str(tmp_path / policy)
        merge_into_day_table(spark, table, scan_intake(spark, str(tmp_path / "intake"), spec), spec, policy)
        got = {r.utcbegin.minute: r.rtlmp for r in spark.read.parquet(table).collect()}
        assert got == {0: 100.0, 5: 200.0, 10: 200.0}


def test_a_cycle_that_fails_and_runs_again_leaves_what_one_run_leaves(spark, tmp_path, monkeypatch):
    import lmplake.plans.cycle as C
    root = str(tmp_path / "pages")
    recs = [_record("2024-01-01T05:00:00", 2156110049, 1), _record("2024-01-01T06:00:00", None, 2), _record("2024-01-01T07:00:00", 9, 3)]
    write_page_folder(spark.createDataFrame([("A", 1, json.dumps(recs))], "pull string, start_row bigint, page_text string"),
                      spark.createDataFrame([("A", 3)], "pull string, total_rows bigint"), root, DA_FEED)
    reqs = _requests(spark, [(DA_FEED, "A", dt.datetime(2024, 1, 1, 5), True)])
    run = lambda: run_fetch_cycle(spark, reqs, DA_FEED, {"root": root}, str(tmp_path / "intake"), str(tmp_path / "serving"),
                                  asset_dimension(spark), landing_id=4, now="2024-01-01 00:00:00", requests_out=str(tmp_path / "next"))
    real = C.upsert_serving
    monkeypatch.setattr(C, "upsert_serving", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
    try:
        run()
    except RuntimeError:
        pass
    monkeypatch.setattr(C, "upsert_serving", real)
    for _ in range(2):
        run()
        count = lambda p: spark.read.parquet(str(tmp_path / p)).count()
        assert (count("intake"), count("next"), count("intake_quarantine"), count("serving/da")) == (2, 1, 1, 1)


def test_two_cycles_chained_by_released_requests(spark, tmp_path):
    from lmplake.operators.pulls import release_requests
    from lmplake.streaming.streams import start_control_stream
    pages, root, msgs = str(tmp_path / "pages"), str(tmp_path / "lake"), str(tmp_path / "msgs")
    for day in (1, 2):
        recs = [_record(f"2024-01-0{day}T{5 + h:02d}:00:00", 9, h) for h in range(3)]
        key = "20240101T0500" if day == 1 else "20240101T0800"
        if day == 2:
            recs = [_record("2024-01-01T08:00:00", 9, 50)]
        write_page_folder(spark.createDataFrame([(key, 1, json.dumps(recs))], "pull string, start_row bigint, page_text string"),
                          spark.createDataFrame([(key, len(recs))], "pull string, total_rows bigint"), pages, DA_FEED, append=day == 2)
    (tmp_path / "msgs").mkdir()
    (tmp_path / "msgs" / "first.txt").write_text(json.dumps(
        {"Data": {"item": json.dumps({"begin_time_iso_str": "2024-01-01T05:00:00+0000", "pjm_end_point": DA_FEED, "queue_next": True})},
         "Metadata": {}}) + "\n")
    run = lambda: start_control_stream(spark, msgs, str(tmp_path / "ck"), root, {DA_FEED: {"root": pages}}, asset_dimension(spark),
                                       now=dt.datetime(2023, 12, 31, 0), envelope=True).awaitTermination()
    run()
    assert spark.read.parquet(f"{root}/{DA_FEED}/intake").count() == 3
    release = lambda now, n: release_requests(spark, f"{root}/requests", msgs, f"{root}/released", now, n).count()
    assert release("2023-12-31 00:00:00", 0) == 0  # not due yet
    assert release("2024-01-02 00:00:00", 1) == 1
    assert release("2024-01-02 00:00:00", 1) == 1  # run again: the same messages
    assert release("2024-01-02 00:00:00", 2) == 0  # released once
    run()
    assert spark.read.parquet(f"{root}/{DA_FEED}/intake").count() == 4
