"""Landing numbers (K1), files of differing types (S7, T3, T4), gap ranges (J3), rejected messages."""
import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from lmplake.feeds import DA_FEED, RT_VERIFIED_FEED, feed
from lmplake.functions.messages import decode_messages, rejected_messages
from lmplake.operators import quality as Q
from lmplake.operators.serve import asset_dimension
from lmplake.plans import adapters as A
from lmplake.sinks import landings as L
from lmplake.sinks.lake import land_intake, lake_columns, stamp_ingest_seq
from lmplake.streaming.streams import start_serving_upsert

SPEC = feed(DA_FEED)
SF = "/root/testdata/sf0.001"


def prices(spark, n=20, day=10, node=1):
    rows = [(dt.datetime(2024, 1, day, 6), dt.date(2024, 1, day), 1, node + i, float(i), 0.0, 0.0, i) for i in range(n)]
    return spark.createDataFrame(rows, "utcbegin timestamp_ntz, pricedate date, hour int, node_id long, dalmp double, damcc double, "
                                       "damcl double, api_row long")


def test_numbers_grow_and_an_owner_keeps_its_own(spark, tmp_path):
    folder = str(tmp_path / "landings")
    first = [L.claim_landing(spark, folder, f"query-a/{b}") for b in range(3)]
    second = [L.claim_landing(spark, folder, f"query-b/{b}") for b in range(3)]  # a new checkpoint counts from 0 too
    assert first == [1, 2, 3] and second == [4, 5, 6]
    assert [L.claim_landing(spark, folder, f"query-a/{b}") for b in range(3)] == first
    # an attempt that died before its owner file was written: its number is not given again
    assert L.Files(spark, folder).create("numbers/7", "someone")
    assert L.claim_landing(spark, folder, "query-c/0") == 8


def test_old_numbers_are_cleared_and_never_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "KEPT", 2)
    folder = str(tmp_path / "landings")
    got = [L.claim_landing(spark, folder, f"q/{b}") for b in range(8)]
    assert got == list(range(1, 9)) and sorted(L.Files(spark, folder).names("numbers")) == ["7", "8"]
    # a slow writer that listed the folder long ago
    real, stale = L.Files.names, iter([["2"]])
    monkeypatch.setattr(L.Files, "names", lambda self, sub: next(stale, None) or real(self, sub))
    assert L.claim_landing(spark, folder, "slow") == 9


def test_claims_at_the_same_time_differ(spark, tmp_path):
    folder, got = str(tmp_path / "landings"), []
    run = lambda w: got.extend(L.claim_landing(spark, folder, f"w{w}/{b}") for b in range(5))
    threads = [threading.Thread(target=run, args=(w,)) for w in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(set(got)) == 20


def test_two_checkpoints_over_one_lake_lose_no_row(spark, tmp_path):
    intake, landings = str(tmp_path / "intake"), str(tmp_path / "landings")
    sent = 0
    for stream in ("a", "b"):
        for wave in range(2):
            rows = prices(spark, 10, day=10 + wave, node=100 * (1 + wave + 2 * (stream == "b")))
            rows.write.mode("append").parquet(str(tmp_path / stream))
            sent += 10
            source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / stream))
            L.start_landing(source, intake, landings, str(tmp_path / f"ck-{stream}"), SPEC).awaitTermination()
    got = spark.read.parquet(intake)
    assert got.count() == sent
    assert sorted(r[0] for r in got.select("landing").distinct().collect()) == [1, 2, 3, 4]
    # the lost checkpoint: the same rows come again, under new numbers, and nothing pending is replaced
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "a"))
    L.start_landing(source, intake, landings, str(tmp_path / "ck-new"), SPEC).awaitTermination()
    again = spark.read.parquet(intake)
    assert again.count() == sent + 20 and again.select("landing").distinct().count() == 5


def test_a_retry_with_other_days_leaves_no_rows_of_the_first_try(spark, tmp_path):
    intake = str(tmp_path / "intake")
    for rows in (prices(spark, 5, day=10).unionByName(prices(spark, 5, day=11)), prices(spark, 6, day=11).unionByName(prices(spark, 2, day=12))):
        land_intake(stamp_ingest_seq(rows, 3), intake, SPEC, 3)
    land_intake(stamp_ingest_seq(prices(spark, 4, day=10), 4), intake, SPEC, 4)
    got = spark.read.parquet(intake).groupBy("landing", F.dayofmonth("pricedate").alias("d")).count().collect()
    assert sorted(map(tuple, got)) == [(3, 11, 6), (3, 12, 2), (4, 10, 4)]


def test_serving_stream_takes_files_of_any_width(spark, tmp_path):
    rows = A.events_prices(spark, SF).select(*lake_columns(SPEC))
    for i, kind in enumerate(("uint64", "int32", "int64")):
        A.land_typed(rows.where(F.col("node_id") % 3 == i), str(tmp_path / "mixed"), kind, kind)
    land_intake(rows, str(tmp_path / "plain"), SPEC)
    got = []
    for name in ("mixed", "plain"):
        start_serving_upsert(spark, str(tmp_path / name), str(tmp_path / f"s-{name}"), str(tmp_path / f"c-{name}"), SPEC,
                             asset_dimension(spark, A.TEST_ASSETS), max_files_per_trigger=5).awaitTermination()
        got.append(sorted(map(tuple, spark.read.parquet(str(tmp_path / f"s-{name}")).collect())))
    assert got[0] == got[1] and got[0]


@pytest.mark.parametrize("bin_days", [1, 2, 400])
def test_gap_ranges_against_a_plain_loop(spark, bin_days):
    rng = random.Random(bin_days)
    start = dt.datetime(2024, 3, 8)
    have = {g: sorted({start + dt.timedelta(minutes=5 * rng.randrange(4000)) for _ in range(n)}) for g, n in (("a", 300), ("b", 1), (None, 40))}
    have["c"] = [start, start + dt.timedelta(days=900)]
    rows = [(g, t, 1) for g, ts in have.items() for t in ts for _ in range(2)] + [("a", None, 1), ("d", None, 1)]
    df = spark.createDataFrame(rows, "g string, utcbegin timestamp_ntz, _t int")
    step = dt.timedelta(minutes=5)
    want = sorted((str(g), a + step, b - step, (b - a) // step - 1) for g, ts in have.items() for a, b in zip(ts, ts[1:]) if b - a > step)
    got = sorted((str(r.g), r.gap_start, r.gap_end, r.n_missing) for r in Q.gap_ranges(df, ["g"], 5, bin_days=bin_days).collect())
    assert got == want
    listed = Q.gap_report(df, ["g"], 5).groupBy("g").count().collect()
    assert {str(r.g): r["count"] for r in listed} == {g: sum(w[3] for w in want if w[0] == g) for g in {w[0] for w in want}}


def test_refills_cut_ranges_at_the_request_span_and_merge_groups(spark):
    span = feed(RT_VERIFIED_FEED).request_span_minutes
    a = dt.datetime(2024, 1, 1)
    b = a + dt.timedelta(minutes=2 * span + 5)
    gaps = spark.createDataFrame([(RT_VERIFIED_FEED, 1, a, b, 9), (RT_VERIFIED_FEED, 2, a, a, 1), ("unknown", 3, a, a, 1)],
                                 "feed string, node long, gap_start timestamp_ntz, gap_end timestamp_ntz, n_missing long")
    got = Q.refill_requests(gaps).orderBy("begin_utc")
    assert [(r.begin_utc, r.n_gaps) for r in got.collect()] == [(a + dt.timedelta(minutes=i * span), 2 if i == 0 else 1) for i in range(3)]
    back = decode_messages(got.select(F.col("message").alias("value"))).collect()
    assert {(r.kind, r.feed, r.queue_next) for r in back} == {("fetch", RT_VERIFIED_FEED, False)}


def test_rejection_parses_each_message_once(spark):
    msgs = decode_messages(A.event_messages(spark, SF, bad_days=True))
    plan = rejected_messages(msgs, [DA_FEED])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") + plan.count("JsonToStructs(") <= 1


def test_requests_during_a_merge_lead_to_one_rerun(spark, tmp_path):
    from lmplake.streaming.streams import FINISHED, REQUESTED, start_merge_actions
    day = dt.date(2024, 1, 1)
    waves = [[REQUESTED] * 3, [REQUESTED], [REQUESTED, REQUESTED], [FINISHED], [FINISHED], [FINISHED, REQUESTED], [REQUESTED, FINISHED]]
    want = [[("start", 3)], [], [], [("rerun", 3)], [], [("start", 1)], [("start", 1)]]
    seen = 0
    for i, wave in enumerate(waves):
        rows = [("f", day, w) for w in wave] + [("f", None, REQUESTED), (None, day, REQUESTED)]
        spark.createDataFrame(rows, "feed string, merge_date date, what string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        # a new query each time: what is remembered comes from the checkpoint
        events = spark.readStream.schema("feed string, merge_date date, what string").parquet(str(tmp_path / "in"))
        start_merge_actions(events, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        got = spark.read.schema("feed string, merge_date date, action string, n_requests long, batch_id int").parquet(str(tmp_path / "out")) \
            .where(F.col("batch_id") == i).collect()
        assert [(r.action, r.n_requests) for r in got] == want[i], i
        seen += len(got)
    assert seen == 4


def test_merge_waves_decode_the_messages_once(spark, tmp_path):
    """The four waves take the counted requests: none of them decodes the messages again."""
    from lmplake.plans.registry import _merge_events
    from lmplake.streaming.streams import FINISHED, REQUESTED
    days = {3: 2, 5: 1, 6: 4, 10: 3}
    rows = [(dt.datetime(2024, 1, d, 12), "signup") for d, n in days.items() for _ in range(n)] + [(dt.datetime(2024, 1, 3, 12), "click")]
    spark.createDataFrame([(i, t, i, e, 1.0, '{"k": %d}' % i) for i, (t, e) in enumerate(rows)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(str(tmp_path / "events.parquet"))
    waves = _merge_events(spark, str(tmp_path))
    for wave in waves:
        plan = wave._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json(" not in plan and "JsonToStructs(" not in plan
    got = [{(r.merge_date.day, r.what): r["count"] for r in w.groupBy("merge_date", "what").count().collect()} for w in waves]
    ask = lambda *ds: {(d, REQUESTED): days[d] for d in ds}
    assert got == [ask(3, 6), ask(3, 6), {(3, FINISHED): 1}, ask(3, 5, 6, 10)]
