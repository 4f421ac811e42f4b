import random
import zlib

from lmplake.llm import sharding as S

SCHEMA = "doc_id long, text string, shard int"


def check(rows, out, n):
    assert len(out) == len(rows)
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    count = [sum(r["shard"] == i for r in out) for i in range(n)]
    assert sum(count) == len(rows) and max(count) - min(count) <= 1
    for i in range(n):
        assert sorted(r["slot"] for r in out if r["shard"] == i) == list(range(count[i]))
    assert {(r["law"], r["grown_shard"]) for r in out} <= {("rows", None)}


def test_small_groups_stay_whole_and_counts_are_even(frame):
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(150)}" if rng.random() < 0.4 else f"own {i}", 0) for i in range(400)]
    rows += [(1000, None, 0), (1001, None, 0), (1002, "", 0), (None, "own null", 0), (3, rows[3][1], 0), (5, "y" * 200_000, 0)]
    df = S.shard_documents(frame(rows, SCHEMA))
    out = df.collect()
    check(rows, out, 8)
    c = S.cut(df).first()
    start = _random_cut(rows, rng)
    assert c["splits"] <= 0.1 * start


def _random_cut(rows, rng):
    spread = {}
    for _, t, _ in rows:
        spread.setdefault(t, []).append(rng.randrange(8))
    return sum(len(set(v)) - 1 for v in spread.values() if len(v) > 1)


def test_a_group_of_a_third_of_all_rows_fills_few_shards(frame):
    rows = [(i, "copy" if i % 3 == 0 else f"own {i}", 0) for i in range(600)]
    out = S.shard_documents(frame(rows, SCHEMA)).collect()
    check(rows, out, 8)
    used = sorted((sum(1 for r in out if r["shard"] == s and r["doc_id"] % 3 == 0) for s in range(8)), reverse=True)
    assert sum(used[:3]) >= 0.75 * 200  # 200 copies need 2.7 shards of 75


def test_few_rows_and_none(frame):
    rows = [(1, "a", 0), (2, "a", 0), (3, "b", 0)]
    check(rows, S.shard_documents(frame(rows, SCHEMA)).collect(), 8)
    assert S.shard_documents(frame([], SCHEMA)).collect() == []


def test_every_text_twice_keeps_copies_together(frame):
    rows = [(i, f"text {i // 2}", 0) for i in range(1600)]
    df = S.shard_documents(frame(rows, SCHEMA))
    check(rows, df.collect(), 8)
    assert S.cut(df).first()["splits"] <= 0.25 * 800  # 7 in 8 at random


def test_copies_of_a_hub_are_numbered_in_bins(frame, monkeypatch):
    """A hub larger than a bin has bins of its own; places stay gapless and its rows in a line."""
    import functools

    from pyspark.sql import functions as F

    from lmplake.llm.common import u32, with_rank
    rows = [(i, "ab"[i % 2], "hot" if i < 900 else "" if i < 1000 else f"t{i % 400}") for i in range(1500)]
    df = frame(rows, "doc_id long, label string, hub string")
    n = df.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    df = df.join(n, "hub").withColumn("n", F.when(F.col("n") > 1, F.col("n"))) \
        .withColumn("at", u32(F.col("hub"))).withColumn("u", u32(F.col("doc_id")))
    small = functools.partial(with_rank, df, "label", "place", order=["doc_id"], u="at", rows_per_bin=40, together=("hub", "n", "u"))
    out = small()
    assert set(out.columns) == {*df.columns, "place"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_own" in plan and "_sub" in plan
    got = sorted((r["label"], r["place"], r["hub"]) for r in out.collect())
    for label in "ab":
        mine = [(p, h) for lab, p, h in got if lab == label]
        assert [p for p, _ in mine] == list(range(750))
        runs = [h for i, (_, h) in enumerate(mine) if i == 0 or mine[i - 1][1] != h]
        assert runs.count("hot") == 1 and runs.count("") == 1
