"""Intake provenance, file listing, day layout, control-message streams, zone matrix."""
import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lmplake.feeds import DA_FEED, feed
from lmplake.operators.merge import input_manifest, unprocessed_inputs
from lmplake.plans import adapters as A
from lmplake.sinks.lake import land_intake, lake_columns, merge_into_day_table, record_processed
from lmplake.sources.intake import list_files, scan_intake
from lmplake.streaming.streams import control_message_stream, start_pending_merges
from oracle_harness import compare, duck

SPEC = feed(DA_FEED)
SF = "/root/testdata/sf0.01"


def test_intake_scan_provenance_manifest_and_ledger(spark, tmp_path):
    intake = str(tmp_path / "intake")
    prices = A.events_prices(spark, SF)
    land_intake(prices.where(A.arrival_batch() == 0), intake, SPEC)
    land_intake(prices.where(A.arrival_batch() == 1), intake, SPEC)
    landed = scan_intake(spark, intake, SPEC)
    assert landed.count() == prices.count()
    day = landed.where(F.col("pricedate") == dt.date(2024, 1, 10))
    assert day.select("file_path").distinct().count() >= 2
    man = input_manifest(day).collect()
    assert sum(r.n_rows for r in man) == day.count()
    files = list_files(spark, intake)
    assert files.count() == landed.select("file_path").distinct().count()
    ledger = str(tmp_path / "ledger")
    record_processed(day, ledger, 0)
    todo = unprocessed_inputs(landed.select("file_path").distinct(), spark.read.parquet(ledger))
    assert todo.count() == landed.select("file_path").distinct().count() - day.select("file_path").distinct().count()
    # only the requested day's folder is listed and read
    one_day = scan_intake(spark, intake, SPEC, [dt.date(2024, 1, 10)])
    assert "InMemoryFileIndex(1 paths)" in one_day._jdf.queryExecution().executedPlan().toString()
    assert [r.pricedate for r in one_day.select("pricedate").distinct().collect()] == [dt.date(2024, 1, 10)]
    assert scan_intake(spark, intake, SPEC, [dt.date(1999, 1, 1)]).count() == 0


def test_day_layout_sorted_by_node_and_time(spark, tmp_path):
    path = str(tmp_path / "day")
    merge_into_day_table(spark, path, A.events_prices(spark, SF).select(*lake_columns(SPEC)), SPEC)
    days = sorted(d for d in os.listdir(path) if d.startswith("pricedate="))
    assert len(days) == 31
    for d in days[:5]:
        for f in os.listdir(os.path.join(path, d)):
            if f.endswith(".parquet"):
                t = pq.read_table(os.path.join(path, d, f)).to_pandas()
                keys = list(zip(t.node_id, t.utcbegin))
                assert keys == sorted(keys)
                assert pq.ParquetFile(os.path.join(path, d, f)).metadata.row_group(0).column(0).compression == "ZSTD"
    from lmplake.operators.merge import node_day_lookup
    look = node_day_lookup(spark.read.parquet(path), [8, 46], days=[dt.date(2024, 1, 10)])
    plan = look._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(node_id), In(node_id, [46,8])]" in plan or "In(node_id" in plan
    assert "PartitionFilters: [isnotnull(pricedate" in plan
    assert look.count() == spark.read.parquet(path).where(
        (F.col("pricedate") == dt.date(2024, 1, 10)) & F.col("node_id").isin(8, 46)).count() > 0


def test_control_stream_and_pending_merges(spark, tmp_path):
    src = tmp_path / "msgs"
    src.mkdir()
    (src / "a.txt").write_text(
        '{"date":"2024-01-05","endpoint":"rt_fivemin_hrl_lmps"}\n'
        '"{\\"date\\":\\"2024-01-05\\",\\"endpoint\\":\\"rt_fivemin_hrl_lmps\\"}"\n'
        '{"date":"2024-01-06","endpoint":"rt_fivemin_hrl_lmps"}\n'
        '{"begin_time_iso_str":"2024-01-01T00:00:00+0000","pjm_end_point":"da_hrl_lmps","queue_next":true}\n')
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        out = str(tmp_path / "out")
        start_pending_merges(control_message_stream(spark, str(src)), out, str(tmp_path / "ck")).awaitTermination()
        got = sorted((r.feed, r.merge_date) for r in spark.read.parquet(out).collect())
        assert got == [("rt_fivemin_hrl_lmps", dt.date(2024, 1, 5)), ("rt_fivemin_hrl_lmps", dt.date(2024, 1, 6))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_merge_requests_for_older_days_and_again(spark, tmp_path):
    src, out = tmp_path / "m", str(tmp_path / "pending")
    src.mkdir()
    for i, days in enumerate((["2024-01-15"], ["2024-01-10", "2024-01-15", "2024-01-15"], ["2024-01-11"])):
        (src / f"{i}.txt").write_text("".join('{"date":"%s","endpoint":"rt_fivemin_hrl_lmps"}\n' % d for d in days))
        start_pending_merges(control_message_stream(spark, str(src)), out, str(tmp_path / "ck")).awaitTermination()
    got = sorted((r.batch_id, str(r.merge_date), r.n_requests) for r in spark.read.parquet(out).collect())
    assert got == [(0, "2024-01-15", 1), (1, "2024-01-10", 1), (1, "2024-01-15", 2), (2, "2024-01-11", 1)]


ZONE_KEYS = ["normalize_prices", "day_boundaries", "expected_at", "request_windows", "control_messages",
             "next_requests", "day_completeness", "parse_timestamps"]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_zone_matrix(spark, zone):
    con = duck(SF)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for k in ZONE_KEYS:
            r = compare(E.queries()[k](spark, SF), con, E.oracle_sql()[k])
            assert r["ok"], (zone, k, r)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_one_stream_owns_the_intake_and_archives_it(spark, tmp_path):
    from lmplake.operators.serve import asset_dimension
    from lmplake.streaming.streams import start_day_merge
    root = tmp_path
    prices = A.events_prices(spark, SF).select(*lake_columns(SPEC))
    land_intake(prices, str(root / "intake"), SPEC)
    q = start_day_merge(spark, str(root / "intake"), str(root / "day"), str(root / "ck"), SPEC,
                        serving_root=str(root / "serving"), assets=asset_dimension(spark, A.TEST_ASSETS),
                        archive_dir=str(root / "archive"), max_files_per_trigger=8)
    q.awaitTermination()
    day = spark.read.parquet(str(root / "day"))
    assert day.count() == prices.groupBy("node_id", "utcbegin").count().count()
    assert spark.read.parquet(str(root / "serving" / "da")).select("node").distinct().count() == 3
    left = [f for _, _, fs in os.walk(root / "intake") for f in fs if f.endswith(".parquet")]
    archived = [f for _, _, fs in os.walk(root / "archive") for f in fs if f.endswith(".parquet")]
    assert archived and len(left) <= 8  # files of the last micro-batch may still await their clean-up
