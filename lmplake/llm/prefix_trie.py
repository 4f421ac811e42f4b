"""Prefix trie of conversations, with subtree sums by the Euler-tour technique.

A node of depth d is a distinct sequence of d turns (role, text); the root is the empty one.

1. ``ordered_turns`` numbers the turns of each conversation; a turn travels as the digest of
   (role, text) and the bytes of its text, texts themselves are not shuffled.
2. Prefixes are named by two sums of digest values times powers of a base, modulo 2^61 - 1,
   which can be summed over pieces of a conversation: rows are sorted by (conversation, turn)
   into ranges, each range sums what it has, and a conversation cut by a border takes over the
   sums of the ranges before. So one conversation with a third of all turns is many tasks' work.
   Names are proved, not trusted: all rows of a name must agree in the SHA-256 of their last
   turn and in the name of their parent, or the job fails.
3. Nodes are numbered in the order of (smallest member, depth). Each has an enter and an exit
   arc; the tour goes from an enter arc to the first child's, or to the own exit arc; from an
   exit arc to the next sibling's enter arc, or to the parent's exit arc. Siblings are ordered by
   number, in bins of numbers: the last of a bin is handed the first of the next.
4. The tour is ranked (``listrank``) and sums run along it; what a subtree adds up to is the
   difference between its exit and enter arc.
5. The members that end in a node are digested as a stream over sorted pieces of the list.

Defined cases: null role or text is empty; turns are ordered by turn (null first), rows of
equal turn by their digest; rows with a null conversation are left out; other columns are
ignored; an empty table gives no node, a conversation without turns ends in the root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lmplake.llm import listrank
from lmplake.llm.common import join_sized, map_arrow, numbered, sorted_ranges, written

U64 = np.uint64
P61 = (1 << 61) - 1
BASES = (0x1A2F5D3C9B7E6481 % P61, 0x0D6E8FEB86659FD9 % P61)  # any two numbers below 2^61 - 1
BIN = 1 << 14
KEY = ["depth", "s1", "s2"]
RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


# ---------------------------------------------------------------- turns

def digest(role: Column, text: Column) -> Column:
    """Equal for equal (role, text): SHA-256 of the role's length, the role and the text."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos from 1, turn_sha, n_bytes) and conversations (conv, n)."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = written(conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), digest(role_, text_).alias("turn_sha"),
        F.octet_length(text_).cast("long").alias("n_bytes")), "turns")
    rows = written(numbered(rows, ["conv", F.asc_nulls_first("turn"), "turn_sha"], "idx").drop("turn"), "turns")
    convs = written(rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first")), "convs")
    turns = join_sized(rows, convs, ["conv"], "n", total_turns(convs), "inner") \
        .select("conv", (F.col("idx") - F.col("first") + 1).alias("pos"), "turn_sha", "n_bytes")
    return written(turns, "ordered"), convs.select("conv", "n")


def total_turns(convs: DataFrame) -> int:
    return convs.agg(F.sum("n")).first()[0] or 0


# ---------------------------------------------------------------- prefix names

def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, of values below it."""
    ah, al, bh, bl = a >> U64(32), a & U64(0xFFFFFFFF), b >> U64(32), b & U64(0xFFFFFFFF)
    mid, low = ah * bl + al * bh, al * bl
    r = ((ah * bh) << U64(3)) + (mid >> U64(29)) + ((mid & U64((1 << 29) - 1)) << U64(32)) + (low & U64(P61)) + (low >> U64(61))
    return _fold(r)


def _fold(r: np.ndarray) -> np.ndarray:
    r = (r & U64(P61)) + (r >> U64(61))
    return np.where(r >= U64(P61), r - U64(P61), r)


def powmod(base: int, exponent: np.ndarray) -> np.ndarray:
    out, square, left = np.ones(len(exponent), U64), np.full(1, base, U64), exponent.astype(U64)
    while left.any():
        out = np.where(left & U64(1), mulmod(out, np.broadcast_to(square, out.shape)), out)
        square, left = mulmod(square, square), left >> U64(1)
    return out


def running(terms: np.ndarray) -> np.ndarray:
    """Running sums modulo 2^61 - 1."""
    low, high = np.cumsum(terms & U64((1 << 31) - 1)), np.cumsum(terms >> U64(31))
    return _fold(mulmod(_fold(high), np.full(1, 1 << 31, U64)) + _fold(low))


def _prefix_sums(batches):
    """Sums of each conversation's terms up to the row (s) and before it (p), inside one range."""
    conv_before, carried = None, (0, 0)
    for b in batches:
        if not b.num_rows:
            continue
        conv, pos = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        raw = np.frombuffer(b"".join(bytes.fromhex(x[:32]) for x in b.column(2).to_pylist()), ">u8").astype(U64).reshape(-1, 2)
        start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(conv)]))
        names, columns, last = ["conv", "pos", "turn_sha", "n_bytes", "is_end", "at", "s1", "p1", "s2", "p2"], [], []
        for k, base in enumerate(BASES):
            term = mulmod(_fold(raw[:, k]), powmod(base, pos))
            total = running(term)
            before = np.where(start > 0, total[start - 1], U64(0))
            here = _fold(total + (U64(P61) - before)[group])
            if conv_before == conv[0]:
                here[group == 0] = _fold(here[group == 0] + U64(carried[k]))
            last.append(int(here[-1]))
            columns += [here, _fold(here + U64(P61) - term)]
        conv_before, carried = conv[-1], tuple(last)
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c.astype(np.int64)) for c in columns]], names=names)


def prefix_names(turns: DataFrame) -> DataFrame:
    """turns (conv, pos, turn_sha, n_bytes, is_end), a written table, plus the names s1, s2 of the prefix that
    ends with the turn and p1, p2 of the one before it (0, 0: the root)."""
    rows = sorted_ranges(turns.select("conv", "pos", "turn_sha", "n_bytes", "is_end"), ["conv", "pos"], "at")
    local = written(map_arrow(rows, _prefix_sums, "conv long, pos long, turn_sha string, n_bytes long, is_end boolean, at long, "
                              "s1 long, p1 long, s2 long, p2 long"), "prefixes").withColumn("range", F.shiftright("at", 33))
    # the last conversation of a range may go on in the next ones
    tail = local.groupBy("range").agg(F.max_by(F.struct("conv", "s1", "s2"), "at").alias("t")).select("range", "t.*")
    run = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = tail.select("conv", (F.col("range") + 1).alias("range"), *[F.sum(F.col(s).cast("decimal(38,0)")).over(run).alias(f"o{s}")
                                                                     for s in ("s1", "s2")])
    joined = local.join(F.broadcast(ends), ["conv", "range"], "left")  # one row a range

    def shifted(c: str, by: str) -> Column:
        moved = (F.col(c).cast("decimal(38,0)") + F.col(by)) % F.lit(P61)
        return F.when(F.col(by).isNull(), F.col(c)).otherwise(moved.cast("long")).alias(c)

    return joined.select("conv", F.col("pos").alias("depth"), "turn_sha", "n_bytes", "is_end", shifted("s1", "os1"), shifted("s2", "os2"),
                         shifted("p1", "os1"), shifted("p2", "os2"))


# ---------------------------------------------------------------- members that end in a node

def _pieces(batches):
    """Ids of a node, neighbours in the sorted rows, as one comma-joined piece for each batch."""
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
        conv = b.column(3).to_pylist()
        cut = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(conv)]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(i).take(pa.array(cut[:-1])) for i in range(4)],
             pa.array([",".join(map(str, conv[i:j])) for i, j in zip(cut[:-1], cut[1:])], pa.string())],
            names=[*KEY, "first", "ids"])


def _hash_pieces(batches):
    """SHA-256 of each node's pieces, which come one after the other: one piece in memory at a time."""
    current, state = None, None
    out: list[tuple] = []
    for b in batches:
        for *key, _, ids in zip(*[c.to_pylist() for c in b.columns]):
            if key == current:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((*current, state.hexdigest()))
            current, state = key, hashlib.sha256(ids.encode())
        if out:
            yield _digests(out)
            out = []
    if state is not None:
        yield _digests([(*current, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                                      names=[*KEY, "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, s1, s2, ends_sha256) of (depth, s1, s2, conv)."""
    rows = sorted_ranges(ends, [*KEY, "conv"], "at").drop("at")
    pieces = map_arrow(rows, _pieces, "depth long, s1 long, s2 long, first long, ids string")
    return map_arrow(pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first"), _hash_pieces,
                     "depth long, s1 long, s2 long, ends_sha256 string")


# ---------------------------------------------------------------- nodes and the tour

def _nodes(named: DataFrame, convs: DataFrame) -> DataFrame:
    proved = (F.min("turn_sha") == F.max("turn_sha")) & (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2"))
    inner = named.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), proved.alias("proved"))
    inner = inner.select(F.when(F.col("proved"), F.col("depth")).otherwise(F.raise_error(F.lit("two prefixes have one name"))).cast("long")
                         .alias("depth"), "s1", "s2", "conv_id", "n_convs", "n_bytes", "p1", "p2")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).select(
        zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), "conv_id", "n_convs", zero.alias("n_bytes"), zero.alias("p1"), zero.alias("p2"))
    return inner.unionByName(root)


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes with their parent's number and smallest member, first child and number of children."""
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2")]
    below = nodes.where("depth > 0").select(*up, "num").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("num").alias("first_child"))
    nodes = written(nodes.join(below, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    children = nodes.where("depth > 0").withColumn("up", F.col("depth") - 1)
    parents = nodes.where("n_children > 0").select(F.col("depth").alias("up"), F.col("s1").alias("p1"), F.col("s2").alias("p2"),
                                                   F.col("num").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                                                   F.col("n_children").alias("siblings"))
    linked = join_sized(children, parents, ["up", "p1", "p2"], "siblings", nodes.count(), "inner")
    keep = ["num", *KEY, "conv_id", "n_convs", "n_bytes", "n_children", "first_child"]
    none = F.lit(None).cast("long")
    return written(linked.select(*keep, "parent", "parent_conv_id").unionByName(
        nodes.where("depth = 0").select(*keep, none.alias("parent"), none.alias("parent_conv_id"))), "linked")


def _tour(linked: DataFrame) -> DataFrame:
    """(id, succ): arc 2v enters node v, arc 2v + 1 leaves it."""
    kids = linked.where("parent is not null").select("num", "parent", F.floor(F.col("num") / BIN).alias("bin"))
    bins = kids.groupBy("parent", "bin").agg(F.min("num").alias("first"))
    handed = bins.select("parent", "bin", F.lead("first").over(Window.partitionBy("parent").orderBy("bin")).alias("next_bin"))
    inside = kids.withColumn("next", F.lead("num").over(Window.partitionBy("parent", "bin").orderBy("num")))
    edge = inside.where("next is null").join(handed, ["parent", "bin"]).select("num", "parent", F.col("next_bin").alias("next"))
    sibling = inside.where("next is not null").select("num", "parent", "next").unionByName(edge)
    leave = sibling.select((2 * F.col("num") + 1).alias("id"), F.coalesce(2 * F.col("next"), 2 * F.col("parent") + 1).alias("succ"))
    root = linked.where("parent is null").select((2 * F.col("num") + 1).alias("id"), F.lit(-1).cast("long").alias("succ"))
    enter = linked.select((2 * F.col("num")).alias("id"), F.coalesce(2 * F.col("first_child"), 2 * F.col("num") + 1).alias("succ"))
    return enter.unionByName(leave).unionByName(root)


def _subtree_sums(linked: DataFrame, pos: DataFrame) -> DataFrame:
    """(num, n_leaves, saved_tokens): differences of the sums along the tour."""
    weights = {"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0),
               "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}
    arcs = pos.withColumn("num", F.shiftright("id", 1)).withColumn("enters", F.col("id") % 2 == 0)
    own = linked.select("num", *[w.cast("long").alias(c) for c, w in weights.items()])
    arcs = written(arcs.join(own, "num").select("num", "enters", "pos", F.floor(F.col("pos") / BIN).alias("block"),
                                                *[F.when(F.col("enters"), F.col(c)).otherwise(0).alias(c) for c in weights]), "arcs")
    blocks = arcs.groupBy("block").agg(*[F.sum(c).alias(f"b_{c}") for c in weights])
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("block", *[F.coalesce(F.sum(f"b_{c}").over(before), F.lit(0)).alias(f"b_{c}") for c in weights])
    inside = Window.partitionBy("block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    sums = arcs.select("num", "enters", "block", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in weights]) \
        .join(base, "block")
    signed = [F.sum(F.when(F.col("enters"), -1).otherwise(1) * (F.col(c) + F.col(f"b_{c}"))).cast("long").alias(c) for c in weights]
    return sums.groupBy("num").agg(*signed)


def build(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node (see ``RESULT``): turns (conv, pos, turn_sha, n_bytes), pos gapless from 1, and
    conversations (conv, n) with their number of turns, those without turns too."""
    if convs.isEmpty():
        return convs.sparkSession.createDataFrame([], RESULT)
    counted = join_sized(turns, convs, ["conv"], "n", total_turns(convs), "inner").withColumn("is_end", F.col("pos") == F.col("n"))
    named = written(prefix_names(written(counted, "counted")), "named")
    nodes = numbered(written(_nodes(named, convs), "unnumbered"), ["conv_id", "depth"], "num")
    linked = _linked(written(nodes, "nodes"))
    sums = _subtree_sums(linked, listrank.rank(_tour(linked)))
    zero = F.lit(0).cast("long")
    ends = named.where("is_end").select(*KEY, "conv").unionByName(
        convs.where("n = 0").select(zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), "conv"))
    digests = ends_digest(written(ends, "ends"))
    nothing = hashlib.sha256(b"").hexdigest()
    return linked.join(sums, "num").join(digests, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def share_prefixes(turns: DataFrame, convs: DataFrame, head: Column, donor: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Rebuild each conversation: the first ``head`` (at most ``most``) turns of conversation ``donor`` (all if it has fewer, none if it
    doesn't exist), then its own turns behind its first ``head``. ``head`` and ``donor`` are columns over conv.
    Returns turns and conversations as ``build`` takes them."""
    wanted = convs.select("conv", "n", head.cast("long").alias("h"), donor.cast("long").alias("donor"))
    plan = written(wanted.join(convs.select(F.col("conv").alias("donor"), F.col("n").alias("donor_n")), "donor", "left").select(
        "conv", "n", "h", "donor", F.least("h", F.coalesce("donor_n", F.lit(0))).cast("long").alias("taken")), "plan")
    own = join_sized(turns, plan, ["conv"], "n", total_turns(convs), "inner").where("pos > h") \
        .select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_sha", "n_bytes")
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "donor")
    lent = heads.join(plan.where("taken > 0").select("conv", "h", "donor"), "donor").where("pos <= h") \
        .select("conv", "pos", "turn_sha", "n_bytes")
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return written(own.unionByName(lent), "rebuilt"), written(plan.select("conv", length.cast("long").alias("n")), "lengths")
