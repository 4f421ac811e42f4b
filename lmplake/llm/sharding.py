"""Sharding by balanced label propagation.

Documents are linked through hubs: every document of a hub (here: of the same text)
is a neighbour of the others. Labels are shards. All documents start at a hashed
shard; in each round the labels of a hub's documents are counted (an aggregate over
(hub, shard), no neighbour list), and each linked document asks for the shard that
holds most of its neighbours. Requests are granted under quotas: between two shards
as many documents move one way as the other, and beyond that only into room that a
shard has left (its capacity less its linked documents). For a hub that is larger than
a shard, a shard that is full is asked for no more, so it fills one after the other. A grant is
by the hub's hash, so that a hub moves as a whole, and by the document's hash for hubs
that are a large part of a shard. Rounds end when no request is left or after ``rounds``.

Capacities are exact at the end (law ``rows``: counts differ by one at most): in each
shard documents are ranked, linked ones first, and those beyond the capacity fill the
places left in other shards, so unlinked documents are what evens out the sizes.

Only (hub, document, hash, label) rows move through the rounds, never texts; the
counts of shards and of pairs of shards are all that reaches the driver. Ranks come
from bins of the hash, so no shard is ranked by one task.

Defined cases: a null text is a group of its own (null equals null), an empty text
another one; null and repeated keys are rows like others (equal rows may swap
places); fewer rows than shards leave shards empty; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import join_sized, prepare, u32, with_rank, written

ROUNDS = 6
LARGE = 0.02
_ONE = float(1 << 32)


def _quotas(asked: dict, sizes: list[int], room: list[float]) -> dict:
    """Share of the requests (from, to) that is granted: swaps, then free room."""
    n = len(sizes)
    grant = {k: min(v, asked.get((k[1], k[0]), 0)) for k, v in asked.items()}
    for to in range(n):
        free = max(0.0, room[to] - sizes[to])
        left = {k: asked[k] - grant[k] for k in asked if k[1] == to and asked[k] > grant[k]}
        total = sum(left.values())
        for k, v in left.items():
            grant[k] += v * min(1.0, free / total)
    return {k: grant[k] / asked[k] for k in asked}


def propagate(nodes: DataFrame, n_shards: int, rounds: int = ROUNDS, large: float = LARGE) -> DataFrame:
    """nodes: (hub, u, ...) with a hash u of the row; adds linked and label."""
    total = nodes.count()
    cap = total / n_shards
    sizes_of_hub = nodes.groupBy("hub").agg(F.count(F.lit(1)).alias("hub_rows")).where("hub_rows > 1")
    cur = written(join_sized(nodes, sizes_of_hub, ["hub"], "hub_rows", total)
                  .withColumn("linked", F.col("hub_rows").isNotNull())
                  .withColumn("label", F.floor(F.col("u") * n_shards / F.lit(_ONE)).cast("int")), "labels")
    columns = cur.columns
    for turn in range(rounds):
        # only linked documents take up room: the others give way in the end
        counts = {r["label"]: r["n"] for r in
                  cur.where("linked").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = [counts.get(i, 0) for i in range(n_shards)]
        full = [i for i in range(n_shards) if sizes[i] >= cap * (1 - large)]
        open_ = ~F.col("label").isin(full) if full else F.lit(True)
        held = cur.where("linked").groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"), F.max("hub_rows").alias("rows"))
        # swaps need no room: only a hub larger than a shard has to leave out full ones
        may = open_ | (F.col("rows") <= F.lit(cap))
        # the shard that has most of the hub's documents; ties by a hash of the hub, another one in each round
        best = held.where(may).groupBy("hub").agg(F.max(F.struct("n", F.hash("hub", "label", F.lit(turn)).alias("t"), "label")).alias("b")) \
            .select("hub", F.col("b.label").alias("want"))
        small = F.col("n") <= F.lit(cap * large)
        ask = written(held.join(best, "hub").where((F.col("label") != F.col("want")) & (may | small)), "asks")
        asked = {(r["label"], r["want"]): r["n"] for r in
                 ask.groupBy("label", "want").agg(F.sum("n").alias("n")).collect()}
        if not asked:
            break
        share = _quotas(asked, sizes, [cap] * n_shards)
        quota = F.create_map(*[F.lit(x) for (a, b), p in share.items() for x in (a * n_shards + b, float(p))])
        p = quota[F.col("label") * n_shards + F.col("want")]
        # a hub moves as a whole, unless it is a large part of what is granted
        whole = small
        moves = ask.withColumn("p", p).withColumn("whole", whole) \
            .where(~F.col("whole") | (u32(F.lit("hub"), F.col("hub"), F.col("label")) < F.col("p") * _ONE)) \
            .select("hub", "label", "want", "p", "whole", "n")
        moved = join_sized(cur.where("linked"), moves, ["hub", "label"], "n", total).withColumn(
            "label", F.when(F.col("want").isNotNull() & (F.col("whole") | (u32(F.lit("row"), F.col("u")) < F.col("p") * _ONE)),
                            F.col("want")).otherwise(F.col("label")))
        cur = written(cur.where("not linked").select(*columns).unionByName(moved.select(*columns)), "labels")
    return cur


def balance(labelled: DataFrame, n_shards: int, order: list[str]) -> DataFrame:
    """Adds shard and slot (0-based, gapless): counts differ by one at most."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    have = [counts.get(i, 0) for i in range(n_shards)]
    # the larger shards keep the one document more
    extra = set(sorted(range(n_shards), key=lambda i: (-have[i], i))[:total % n_shards])
    cap = [total // n_shards + (i in extra) for i in range(n_shards)]
    # linked documents come first: the rank's hash has its first bit from "linked", and a hub's documents stand together
    rank = (F.when(F.col("linked"), F.lit(0)).otherwise(F.lit(1 << 31)) + F.shiftrightunsigned(u32(
        F.col("hub"), F.when(~F.col("linked"), F.col("u"))), 1)).cast("long")
    ranked = with_rank(labelled.withColumn("_rank", rank), "label", "_place", order=["u", *order], u="_rank", key_counts=counts,
                       together=("hub", "hub_rows", "u"))
    caps = F.array(*[F.lit(c) for c in cap])
    ranked = written(ranked.withColumn("_over", F.col("_place") >= caps[F.col("label")]), "ranked")
    stay = ranked.where("not _over").select("*", F.col("label").alias("shard"), F.col("_place").alias("slot"))
    spill = sum(max(0, h - c) for h, c in zip(have, cap))
    if spill:
        # the places that are left, one range for each shard, in one line
        starts, ends, at = [], [], 0
        for h, c in zip(have, cap):
            starts.append(at)
            at += max(0, c - h)
            ends.append(at)
        over_before, done = [], 0
        for h, c in zip(have, cap):
            over_before.append(done)
            done += max(0, h - c)
        line = F.array(*[F.lit(x) for x in over_before])[F.col("label")] + F.col("_place") - caps[F.col("label")]
        to = F.lit(0)
        for e in ends[:-1]:
            to = to + F.when(F.col("_line") >= e, 1).otherwise(0)
        moved = ranked.where("_over").withColumn("_line", line.cast("long")).withColumn("shard", to.cast("int")) \
            .withColumn("slot", (F.array(*[F.lit(h) for h in have])[F.col("shard")] + F.col("_line")
                                 - F.array(*[F.lit(x) for x in starts])[F.col("shard")]).cast("long"))
        stay = stay.unionByName(moved.drop("_line"))
    return stay.drop("_rank", "_place", "_over")


def shard_documents(docs: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, group_id, start_shard) for each document."""
    prepare(docs.sparkSession)
    t = F.col(text)
    nodes = written(docs.select(
        F.col(key).alias("key"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(t, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.sha2(t, 256), F.lit("")).alias("hub")) \
        .withColumn("u", u32(F.col("key").cast("string"), F.col("hub"))), "nodes")
    labelled = propagate(nodes, n_shards, rounds)
    placed = balance(labelled, n_shards, ["key"])
    return placed.select(F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"),
                         F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), F.col("hub").alias("group_id"))


def cut(placed: DataFrame, group: str = "group_id") -> DataFrame:
    """(linked rows, shards beyond the first that groups are spread over, cut pairs of documents)."""
    cells = placed.groupBy(group, "shard").agg(F.count(F.lit(1)).alias("n"))
    groups = cells.groupBy(group).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("shards"),
                                      F.sum(F.col("n") * F.col("n")).alias("inside"))
    return groups.where("rows > 1").agg(F.sum("rows").alias("linked"), F.sum(F.col("shards") - 1).alias("splits"),
                                        (F.sum(F.col("rows") * F.col("rows") - F.col("inside")) / 2).alias("cut_pairs"))
