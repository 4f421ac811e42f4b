"""Versioned day tables (K3): readers see the old or the new state, never a part."""
import datetime as dt
import threading

import pytest

from lmplake.feeds import DA_FEED, feed
from lmplake.sinks import versions as V
from lmplake.sinks.landings import Files

SPEC = feed(DA_FEED)


def rows(spark, price, days, seq, nodes=3):
    out = [(dt.datetime(2024, 1, d, 6), dt.date(2024, 1, d), 1, n, float(price), 0.0, 0.0, seq) for d in days for n in range(nodes)]
    return spark.createDataFrame(out, "utcbegin timestamp_ntz, pricedate date, hour int, node_id long, dalmp double, damcc double, damcl double, ingest_seq long")


def state(spark, table, **k):
    return sorted((r.pricedate.day, r.node_id, r.dalmp) for r in V.read_versioned(spark, table, SPEC, **k).collect())


def want(days, price, nodes=3):
    return [(d, n, float(price)) for d in days for n in range(nodes)]


def test_a_reader_between_any_two_steps_sees_whole_states(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "day")
    assert state(spark, table) == []
    assert V.merge_versioned(spark, table, rows(spark, 1, [1, 2, 3], 1), SPEC) == 1
    seen = []
    for name in ("create", "move", "delete", "read", "names"):
        real = getattr(Files, name)

        def stepped(self, *a, real=real, busy=[], **k):
            if not busy:  # read before and after each file operation of the merge
                busy.append(1)
                seen.append(state(spark, table))
                busy.clear()
                out = real(self, *a, **k)
                busy.append(1)
                seen.append(state(spark, table))
                busy.clear()
                return out
            return real(self, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(Files, name, stepped)
            V.merge_versioned(spark, table, rows(spark, 2 + len(seen), [2, 3, 4], 2 + len(seen)), SPEC)
    wholes = {tuple(state(spark, table, version=v)) for v in range(1, 7)}
    assert len(seen) >= 10 and {tuple(s) for s in seen} <= wholes and len(wholes) == 6


def test_a_merge_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "day")
    V.merge_versioned(spark, table, rows(spark, 1, [1, 2], 1), SPEC)
    with monkeypatch.context() as m:
        m.setattr(V, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            V.merge_versioned(spark, table, rows(spark, 2, [1, 2], 2), SPEC)
    assert state(spark, table) == want([1, 2], 1)
    V.merge_versioned(spark, table, rows(spark, 2, [1], 2), SPEC)  # the retry
    assert state(spark, table) == want([1], 2) + want([2], 1)
    assert state(spark, table, version=1) == want([1, 2], 1)
    assert state(spark, table, days=[dt.date(2024, 1, 2), dt.date(2030, 1, 1)]) == want([2], 1)


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    table = str(tmp_path / "day")
    threads = [threading.Thread(target=V.merge_versioned, args=(spark, table, rows(spark, s, [1, s + 1], s), SPEC)) for s in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert state(spark, table) == sorted(want([1], 4) + [x for s in range(1, 5) for x in want([s + 1], s)])
    assert V.latest_version(spark, table) == 4


def test_vacuum_keeps_what_recent_versions_read(spark, tmp_path):
    table = str(tmp_path / "day")
    for s in range(1, 6):
        V.merge_versioned(spark, table, rows(spark, s, [1, 1 + s], s), SPEC)
    before = [state(spark, table, version=v) for v in (4, 5)]
    assert V.vacuum(spark, table, keep=2) > 0
    assert [state(spark, table, version=v) for v in (4, 5)] == before
    with pytest.raises(FileNotFoundError):
        state(spark, table, version=1)
    assert {r.version for r in V.history(spark, table).collect()} == {4, 5}
    assert V.vacuum(spark, table, keep=2) == 0


def scanned(df):
    """Rows that the file scan gave out, from the executed plan's own counter."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_node_lookups_skip_days_by_bloom_filter(spark, tmp_path):
    """Nodes that lie inside a day's range but not in it: without a day in the lookup, no row is read."""
    from pyspark.sql import functions as F

    from lmplake.sinks.lake import write_day_partitions
    table = str(tmp_path / "day")
    days = rows(spark, 1, [1, 2, 3], 1, nodes=200).withColumn("node_id", F.col("node_id") * 7)
    write_day_partitions(days, table)
    days.write.partitionBy("pricedate").parquet(str(tmp_path / "plain"))
    lookup = lambda path, node: spark.read.parquet(path).where(F.col("node_id") == node).select("dalmp")
    assert lookup(table, 700).count() == 3
    absent = [n for n in range(100, 1300) if n % 7][:40]
    with_bloom = sum(scanned(lookup(table, n)) for n in absent)
    without = sum(scanned(lookup(str(tmp_path / "plain"), n)) for n in absent)
    assert with_bloom * 5 < without
