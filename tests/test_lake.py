"""Day table on disk: merge, replay, late rows, unreadable partitions."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lmplake.feeds import DA_FEED, feed
from lmplake.functions.time_cols import hour_ending, market_date
from lmplake.sinks.lake import merge_into_day_table
from lmplake.sources.intake import scan_day_table

SPEC = feed(DA_FEED)


def _prices(spark, rows):
    df = spark.createDataFrame(rows, "utcbegin timestamp_ntz, node_id bigint, dalmp double, ingest_seq bigint")
    return df.select("utcbegin", market_date("utcbegin").alias("pricedate"), hour_ending("utcbegin").alias("hour"),
                     "node_id", "dalmp", F.lit(0.0).alias("damcc"), F.lit(0.0).alias("damcl"), "ingest_seq")


def _table(spark, path):
    return {(r.node_id, r.utcbegin, r.dalmp) for r in spark.read.parquet(path).collect()}


def test_merge_replay_and_late_row(spark, tmp_path):
    path = str(tmp_path / "day")
    d1 = [(dt.datetime(2024, 1, 1, 5 + h), n, float(n * 100 + h), n * 100 + h) for n in (1, 2) for h in range(3)]
    assert merge_into_day_table(spark, path, _prices(spark, d1), SPEC) == [dt.date(2024, 1, 1)]
    before = _table(spark, path)
    assert len(before) == 6
    # a later day does not touch the first day's folder
    d2 = [(dt.datetime(2024, 1, 2, 6), 1, 7.0, 1000)]
    merge_into_day_table(spark, path, _prices(spark, d2), SPEC)
    assert _table(spark, path) == before | {(1, dt.datetime(2024, 1, 2, 6), 7.0)}
    # a late revision for the old day replaces exactly one row; replaying it changes nothing
    late = _prices(spark, [(dt.datetime(2024, 1, 1, 6), 2, -1.0, 2000)])
    merge_into_day_table(spark, path, late, SPEC)
    after = _table(spark, path)
    merge_into_day_table(spark, path, late, SPEC)
    assert _table(spark, path) == after
    assert (2, dt.datetime(2024, 1, 1, 6), -1.0) in after and (2, dt.datetime(2024, 1, 1, 6), 201.0) not in after
    assert len(after) == 7
    files = [f for f in os.listdir(os.path.join(path, "pricedate=2024-01-01")) if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_absent_table_is_empty_but_unreadable_day_fails(spark, tmp_path):
    assert scan_day_table(spark, str(tmp_path / "nope"), SPEC).count() == 0
    path = tmp_path / "day"
    merge_into_day_table(spark, str(path), _prices(spark, [(dt.datetime(2024, 1, 1, 5), 1, 1.0, 1)]), SPEC)
    part = path / "pricedate=2024-01-01"
    (part / "part-corrupt.zstd.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        merge_into_day_table(spark, str(path), _prices(spark, [(dt.datetime(2024, 1, 1, 6), 1, 2.0, 2)]), SPEC)


def test_empty_batches_change_nothing(spark, tmp_path):
    from lmplake.operators.serve import asset_dimension, asset_upsert
    path = str(tmp_path / "day")
    rows = [(dt.datetime(2024, 1, 1, 5), 1, 1.0, 1)]
    merge_into_day_table(spark, path, _prices(spark, rows), SPEC)
    before = _table(spark, path)
    assert merge_into_day_table(spark, path, _prices(spark, rows).limit(0), SPEC) == []
    assert _table(spark, path) == before
    assets = asset_dimension(spark, [(1, "a")])
    from lmplake.operators.serve import asset_lookup
    serving = asset_lookup(_prices(spark, rows), assets, SPEC, keep=("ingest_seq",))
    assert asset_upsert(serving, serving.limit(0), SPEC).count() == 1


def test_sweep_merges_pending_files_once(spark, tmp_path):
    from lmplake.sinks.lake import land_intake, sweep_intake
    intake, table, ledger = (str(tmp_path / x) for x in ("intake", "day", "ledger"))
    land_intake(_prices(spark, [(dt.datetime(2024, 1, 1, 5), 1, 1.0, 1), (dt.datetime(2024, 1, 2, 5), 2, 2.0, 2)]),
                intake, SPEC)
    assert sorted(sweep_intake(spark, intake, table, ledger, SPEC)) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert sweep_intake(spark, intake, table, ledger, SPEC) == []  # nothing pending
    land_intake(_prices(spark, [(dt.datetime(2024, 1, 1, 5), 1, 9.0, 3)]), intake, SPEC)
    assert sweep_intake(spark, intake, table, ledger, SPEC) == [dt.date(2024, 1, 1)]
    assert _table(spark, table) == {(1, dt.datetime(2024, 1, 1, 5), 9.0), (2, dt.datetime(2024, 1, 2, 5), 2.0)}


def test_sweep_takes_a_backlog_in_waves_and_goes_on_behind_the_last_one(spark, tmp_path, monkeypatch):
    import pytest

    import lmplake.sinks.lake as L
    assert L._waves([("a", 2), ("b", 1), ("c", 1), ("d", 9), ("e", 1)], 3) == [("a", "b"), ("c", "c"), ("d", "d"), ("e", "e")]
    assert L._waves([], 3) == []
    intake, table, ledger = (str(tmp_path / x) for x in ("intake", "day", "ledger"))
    rows = [(dt.datetime(2024, 1, d, 5), d, float(d), d) for d in (1, 2, 3)]
    L.land_intake(_prices(spark, rows), intake, SPEC)
    monkeypatch.setattr(L, "SWEEP_FILES", 1)
    real, calls = L.merge_into_day_table, []

    def dies_in_the_second(*a, **k):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a, **k)

    monkeypatch.setattr(L, "merge_into_day_table", dies_in_the_second)
    with pytest.raises(RuntimeError):
        L.sweep_intake(spark, intake, table, ledger, SPEC)
    assert [n for n, _, _ in _table(spark, table)] == [1]
    assert L.sweep_intake(spark, intake, table, ledger, SPEC) == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]  # the first isn't merged again
    assert _table(spark, table) == {(n, t, v) for t, n, v, _ in rows}
    assert L.sweep_intake(spark, intake, table, ledger, SPEC) == []


def test_publish_interrupted_mid_commit_is_finished_by_the_next_merge(spark, tmp_path):
    import shutil
    from lmplake.sinks.lake import recover_staged, write_day_partitions
    path = str(tmp_path / "day")
    rows = [(dt.datetime(2024, 1, 1, 5 + h), n, float(h), n * 10 + h) for n in (1, 2) for h in range(3)]
    merge_into_day_table(spark, path, _prices(spark, rows), SPEC)
    before = _table(spark, path)
    assert not os.path.exists(os.path.join(path, "_staging")) or not os.listdir(os.path.join(path, "_staging"))
    # crash state: the merged day was staged completely, the old folder deleted, the new one not moved in
    spark.read.parquet(path).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(os.path.join(path, "_staging", "crashed"))
    assert not os.path.exists(os.path.join(path, "_staging", "crashed", "_SUCCESS"))
    open(os.path.join(path, "_staging", "crashed", "_COMPLETE"), "w").close()
    shutil.rmtree(os.path.join(path, "pricedate=2024-01-01"))
    # an incomplete staging folder (crash while staging) must be dropped, not published:
    # this application's at once, another one's when it has not changed for a day
    os.makedirs(os.path.join(path, "_staging", f"{spark.sparkContext.applicationId}_half"))
    os.makedirs(os.path.join(path, "_staging", "other_old"))
    os.utime(os.path.join(path, "_staging", "other_old"), (1, 1))
    os.makedirs(os.path.join(path, "_staging", "other_busy"))
    merge_into_day_table(spark, path, _prices(spark, [(dt.datetime(2024, 1, 3, 6), 3, 9.0, 99)]), SPEC)
    assert _table(spark, path) == before | {(3, dt.datetime(2024, 1, 3, 6), 9.0)}
    assert os.listdir(os.path.join(path, "_staging")) == ["other_busy"]
    assert recover_staged(spark, path, write_day_partitions) == 0


def test_folders_holding_only_staging_read_as_empty(spark, tmp_path):
    from lmplake.operators.serve import asset_dimension
    from lmplake.sinks.lake import upsert_serving
    day, serving = tmp_path / "day", tmp_path / "serving"
    for d in (day, serving):
        os.makedirs(d / "_staging" / "half")  # a first publish that died while staging
    rows = _prices(spark, [(dt.datetime(2024, 1, 1, 5), 1, 1.0, 1)])
    assert merge_into_day_table(spark, str(day), rows, SPEC) == [dt.date(2024, 1, 1)]
    assert upsert_serving(spark, str(serving), rows, asset_dimension(spark, [(1, "a")]), SPEC) == [dt.date(2024, 1, 1)]
    assert spark.read.parquet(str(serving)).count() == 1 and spark.read.parquet(str(day)).count() == 1


def test_sweep_archives_or_deletes_merged_files(spark, tmp_path):
    from lmplake.sinks.lake import land_intake, sweep_intake
    for consume in ("archive", "delete"):
        base = tmp_path / consume
        intake, table, ledger, archive = (str(base / x) for x in ("intake", "day", "ledger", "archive"))
        land_intake(_prices(spark, [(dt.datetime(2024, 1, 1, 5), 1, 1.0, 1), (dt.datetime(2024, 1, 2, 5), 2, 2.0, 2)]),
                    intake, SPEC)
        sweep_intake(spark, intake, table, ledger, SPEC, consume=consume, archive_dir=archive)
        left = [f for _, _, fs in os.walk(intake) for f in fs if f.endswith(".parquet")]
        assert left == [] and len(_table(spark, table)) == 2
        moved = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".parquet")] if consume == "archive" else []
        assert (len(moved) > 0) == (consume == "archive")
        assert sweep_intake(spark, intake, table, ledger, SPEC, consume=consume, archive_dir=archive) == []


def test_null_days_are_merged_like_others(spark, tmp_path):
    path = str(tmp_path / "day")
    for node in (1, 2):
        row = spark.createDataFrame([(None, None, None, node, 1.0, 0.0, 0.0, node)],
                                    "utcbegin timestamp_ntz, pricedate date, hour int, node_id bigint, dalmp double, damcc double, "
                                    "damcl double, ingest_seq bigint")
        merge_into_day_table(spark, path, row, SPEC)
    assert sorted(r.node_id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_unsigned_ids_in_the_intake(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from lmplake.sources.intake import scan_intake
    folder = tmp_path / "intake" / "pricedate=2024-01-01" / "landing=0"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"utcbegin": pa.array([dt.datetime(2024, 1, 1, 5)], pa.timestamp("us")), "hour": pa.array([1], pa.int32()),
                             "node_id": pa.array([2156110049], pa.uint64()), "dalmp": [1.0], "damcc": [0.0], "damcl": [0.0],
                             "ingest_seq": pa.array([7], pa.int64())}), folder / "a.parquet")
    for days in (None, [dt.date(2024, 1, 1)]):
        r = scan_intake(spark, str(tmp_path / "intake"), SPEC, days).first()
        assert (r.node_id, r.ingest_seq, r.pricedate) == (2156110049, 7, dt.date(2024, 1, 1))


def test_stamp_ranges_are_checked(spark):
    from lmplake.sinks.lake import MAX_LANDING, stamp_ingest_seq
    df = spark.createDataFrame([(5,), ((1 << 32) - 1,)], "api_row long")
    assert stamp_ingest_seq(df, MAX_LANDING).count() == 2
    with pytest.raises(ValueError, match="landing_id"):
        stamp_ingest_seq(df, 1_700_000_000)
    with pytest.raises(Exception, match="out of range"):
        stamp_ingest_seq(spark.createDataFrame([(1 << 32,)], "api_row long"), 1).collect()


def test_sweep_reads_pending_files_only_and_checkpoints_no_rows(spark, tmp_path, monkeypatch):
    import lmplake.sinks.lake as L
    intake, table, ledger = (str(tmp_path / x) for x in ("intake", "day", "ledger"))
    seen = []
    real = L.read_intake_files
    monkeypatch.setattr(L, "read_intake_files", lambda s, d, paths, spec: seen.append(paths) or real(s, d, paths, spec))
    L.land_intake(_prices(spark, [(dt.datetime(2024, 1, 1, 5), 1, 1.0, 1)]), intake, SPEC)
    L.sweep_intake(spark, intake, table, ledger, SPEC)
    L.land_intake(_prices(spark, [(dt.datetime(2024, 1, 2, 5), 1, 2.0, 2)]), intake, SPEC)
    L.sweep_intake(spark, intake, table, ledger, SPEC)
    assert len(seen) == 2 and not set(seen[0]) & set(seen[1]) and all("2024-01-02" in p for p in seen[1])
    plan = real(spark, intake, seen[1], SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "ExistingRDD" not in plan


def test_a_long_node_list_and_a_long_asset_list_are_joined(spark, tmp_path, monkeypatch):
    import lmplake.operators.merge as M
    import lmplake.operators.serve as S
    df = _prices(spark, [(dt.datetime(2024, 1, 1, 5), n, 1.0, n) for n in range(30)])
    monkeypatch.setattr(M, "MAX_LITERAL_NODES", 5)
    assert M.node_day_lookup(df, list(range(10, 25))).count() == 15
    monkeypatch.setattr(S, "MAX_BROADCAST_ASSETS", 5)
    assets = S.asset_dimension(spark, [(n, f"n{n}") for n in range(20)])
    assert not hasattr(assets, "_lmplake_bounded_rows")
    assert S.asset_lookup(df, assets, SPEC).count() == 20


def test_rows_without_a_pull_key_are_kept(spark):
    from lmplake.operators.pulls import first_day_filter
    df = spark.createDataFrame([(None, dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 2)), ("a", dt.date(2024, 1, 2))],
                               "pull string, pricedate date")
    assert sorted(map(str, first_day_filter(df, ["pull"]).select("pull").collect())) == ["Row(pull='a')", "Row(pull=None)"]
