"""Node sets as bitmaps (S9, J2, P7) against sets in Python, and in the versioned table."""
import datetime as dt

from lmplake.feeds import DA_FEED, feed
from lmplake.operators import node_sets as N
from lmplake.sinks import versions as V

SPEC = feed(DA_FEED)
EDGES = [0, 1, 2, 7, 8, 9, 63, 64, 65, 32767, 32768, 32769, 65536, 65537, 10**9, 2**62, 2**63 - 1,
         -1, -7, -8, -9, -64, -32767, -32768, -32769, -10**12, -2**63 + 1]


def ids(df):
    return sorted(((r.pricedate, r.node_id) for r in df.collect()), key=str)


def rows(spark, *pairs):
    return spark.createDataFrame([(dt.date(2024, 1, d) if d else None, n) for d, n in pairs], "pricedate date, node_id long")


def test_members_come_back(spark):
    pairs = [(1, n) for n in EDGES] + [(2, n) for n in EDGES[::2]] + [(1, 5)] * 50 + [(1, None), (None, 3)]
    df = rows(spark, *pairs)
    sets = N.node_sets(df)
    assert ids(N.members(sets, N.words("bits"))) == ids(df.distinct())
    assert N.members(N.node_sets(df.limit(0)), N.words("bits")).count() == 0


def test_difference_on_every_bit(spark):
    a = rows(spark, *((1, n) for n in range(-200, 40000, 3)))
    b = rows(spark, *((1, n) for n in range(-200, 40000, 2)))
    both = N.node_sets(a).join(N.node_sets(b).withColumnRenamed("bits", "other"), ["pricedate", "bucket"])
    got = {n for _, n in ids(N.members(both, N.minus("bits", "other")))}
    assert got == set(range(-200, 40000, 3)) - set(range(-200, 40000, 2))


def test_membership(spark):
    sets = N.node_sets(rows(spark, *((1, n) for n in EDGES)))
    for n in EDGES + [3, 66, 32770, -2, -65, 10**9 + 1]:
        assert (sets.where(N.holds_any([n])).count() > 0) == (n in EDGES), n
    assert sets.where(N.holds_any([])).count() == 0


def prices(spark, seq, *pairs):
    out = [(dt.datetime(2024, 1, d, 6), dt.date(2024, 1, d), 1, n, 1.0, 0.0, 0.0, seq) for d, n in pairs]
    return spark.createDataFrame(out, "utcbegin timestamp_ntz, pricedate date, hour int, node_id long, dalmp double, damcc double, damcl double, ingest_seq long")


def pairs(df):
    return sorted((r.pricedate.day, r.node_id) for r in df.collect())


def test_sets_follow_the_table(spark, tmp_path):
    t = str(tmp_path / "day")
    assert pairs(V.table_nodes(spark, t)) == [] and V.read_nodes(spark, t, SPEC, [1]).count() == 0
    V.merge_versioned(spark, t, prices(spark, 1, (1, 10), (1, 20), (2, 10), (3, 40000)), SPEC)
    assert pairs(V.table_carried_over(spark, t)) == []
    V.merge_versioned(spark, t, prices(spark, 2, (1, 20), (1, 30), (2, 50)), SPEC)
    assert pairs(V.table_nodes(spark, t)) == [(1, 10), (1, 20), (1, 30), (2, 10), (2, 50), (3, 40000)]
    assert pairs(V.table_nodes(spark, t, version=1)) == [(1, 10), (1, 20), (2, 10), (3, 40000)]
    assert pairs(V.table_carried_over(spark, t)) == [(1, 10), (2, 10)]
    V.merge_versioned(spark, t, prices(spark, 3, (1, 10)), SPEC)
    assert pairs(V.table_carried_over(spark, t, [dt.date(2024, 1, 1)])) == [(1, 20), (1, 30)]
    assert pairs(V.table_nodes(spark, t)) == pairs(V.read_versioned(spark, t, SPEC).select("pricedate", "node_id").distinct())
    V.vacuum(spark, t, keep=1)
    assert pairs(V.table_nodes(spark, t)) == pairs(V.read_versioned(spark, t, SPEC).select("pricedate", "node_id").distinct())


def test_reads_no_price_file_for_sets_and_only_days_with_the_node(spark, tmp_path):
    t = str(tmp_path / "day")
    V.merge_versioned(spark, t, prices(spark, 1, *((d, n) for d in range(1, 8) for n in (1, 5 + d, 99))), SPEC)
    for df in (V.table_nodes(spark, t), V.table_carried_over(spark, t)):
        assert df.inputFiles() and all("/nodes/" in f for f in df.inputFiles())
    found = V.read_nodes(spark, t, SPEC, [8, 11])
    assert pairs(found) == [(3, 8), (6, 11)]
    assert {f.split("pricedate=")[1][:10] for f in found.inputFiles()} == {"2024-01-03", "2024-01-06"}
    assert V.read_nodes(spark, t, SPEC, [50]).inputFiles() == []


def test_losing_writer_leaves_no_sets(spark, tmp_path, monkeypatch):
    t, real, lost = str(tmp_path / "day"), V._commit, []

    def commit(files, version, manifest):
        if not lost:  # another writer is faster once
            lost.append(version)
            V.merge_versioned(spark, t, prices(spark, 1, (1, 7)), SPEC)
        return real(files, version, manifest)

    monkeypatch.setattr(V, "_commit", commit)
    V.merge_versioned(spark, t, prices(spark, 2, (1, 8)), SPEC)
    assert pairs(V.table_nodes(spark, t)) == [(1, 7), (1, 8)] and pairs(V.table_carried_over(spark, t)) == [(1, 7)]
    assert len(V.Files(spark, t).names("nodes")) == len(V.Files(spark, t).names("versions")) == 2
