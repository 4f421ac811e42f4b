"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: the sources' weights share all words; a source stops at ``max_epochs`` times
its own size, what it can't take is shared out again by weight until no source is
above its limit.

A source's documents stand in a hashed order (their words form one line) and are cut
into blocks of about ``block_words`` words; a document belongs to the block in which
it starts. A target is a number of whole passes over the line and, in a last pass,
the line's first words up to the target, so the last document of that pass is cut
and every source takes its target exactly, to the word. This gives each source an
exact quota of block draws. A tree over the output shards splits the quotas: each
node draws the left half's blocks from its own counts with a multivariate
hypergeometric distribution, until a shard's quotas are left. The draws of a source
are dealt to the shards as disjoint ranges, a Feistel permutation for each pass says
which block a draw is, and a shard's rows are put in hashed order.

Rows are placed by (source, bin of the hash) - the bins of a large source go to many
tasks - and by a running sum over the sums of the bins.

Only one row for each source (size, weight, quotas) is held on the driver.

Defined cases: a null text has size 0 and is never taken; a null source is a source
of its own, after all others; rows that repeat are separate rows (equal rows may swap
places); empty tables give empty results; a source without words has target 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lmplake.llm.common import U64, map_arrow, mix, written
from lmplake.llm.feistel import permute

BLOCK_WORDS = 4096
N_SHARDS = 8
MAX_EPOCHS = 3
BIN_ROWS = 2048
SEED = 20
#: Draws that the tree splits at most; blocks get larger beyond (numpy's limit is 10^9).
MOST_DRAWS = 2 * 10 ** 8
DRAWS = "array<struct<epoch:int,shard:int,draw:bigint,words:bigint,position:bigint>>"


def word_count(text) -> F.Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    bare = F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")


def water_fill(sizes: list[int], weights: list[float], max_epochs: int) -> list[float]:
    """Targets that share sum(sizes) by weight, none above max_epochs times its size."""
    rest, target = float(sum(sizes)), [0.0] * len(sizes)
    active = [i for i, s in enumerate(sizes) if s > 0]
    while active:
        unit = rest / sum(weights[i] for i in active)
        full = [i for i in active if unit * weights[i] > max_epochs * sizes[i]]
        if not full:
            for i in active:
                target[i] = unit * weights[i]
            break
        for i in full:
            target[i] = float(max_epochs * sizes[i])
            rest -= target[i]
        active = [i for i in active if i not in set(full)]
    return target


def split_tree(quotas: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Block quotas [shards, sources]: rows are of equal size (to one), columns sum to ``quotas``."""
    out = np.zeros((n_shards, len(quotas)), np.int64)

    def node(counts: np.ndarray, a: int, b: int, path: int) -> None:
        if b - a == 1:
            out[a] = counts
            return
        mid = (a + b) // 2
        take = int(counts.sum()) * (mid - a) // (b - a)
        rng = np.random.default_rng([seed, path])
        left = rng.multivariate_hypergeometric(counts, take, method="marginals") if counts.sum() else counts
        node(left, a, mid, 2 * path)
        node(counts - left, mid, b, 2 * path + 1)

    node(quotas.astype(np.int64), 0, n_shards, 1)
    return out


class Plan:
    """Per source: size, target, words to take, block length, quotas for the shards."""

    def __init__(self, rows: list, weights: list[float] | None, n_shards: int, block_words: int, max_epochs: int, seed: int):
        rows = sorted(rows, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        self.sources = [r["source"] for r in rows]
        self.docs = [r["docs"] for r in rows]
        self.size = [r["size"] for r in rows]
        weights = weights or [1.0 + i % 3 for i in range(len(rows))]
        self.target = water_fill(self.size, weights, max_epochs)
        self.take = [min(int(round(t)), max_epochs * s) for t, s in zip(self.target, self.size)]
        self.block = max(block_words, -(-sum(self.take) // MOST_DRAWS))
        size, take = np.array(self.size, np.int64), np.array(self.take, np.int64)
        self.blocks = -(-size // self.block)
        self.full = np.where(size > 0, take // np.maximum(size, 1), 0)
        self.last = take - self.full * size
        self.last_blocks = -(-self.last // self.block)
        self.quota = self.full * self.blocks + self.last_blocks
        self.shards = split_tree(self.quota, n_shards, seed)
        self.ends = np.cumsum(self.shards, axis=0)  # [shards, sources]
        self.max_epochs, self.seed = max_epochs, seed

    def draws(self, src: np.ndarray, size: np.ndarray, off: np.ndarray):
        """(row, epoch, shard, draw, words) of all takes of the documents, by row and epoch."""
        cols = [[], [], [], [], []]
        block = off // self.block
        for ep in range(self.max_epochs + 1):
            whole = (ep < self.full[src]) & (size > 0)
            part = (ep == self.full[src]) & (off < self.last[src]) & (size > 0)
            at = np.flatnonzero(whole | part)
            s = src[at]
            n = np.where(whole[at], self.blocks[s], self.last_blocks[s])
            key = mix(s.astype(U64) * U64(8) + U64(ep) + U64(self.seed) * U64(1 << 32))
            draw = ep * self.blocks[s] + permute(block[at], n, key)
            shard = (self.ends[:, s] <= draw).sum(axis=0)
            words = np.where(whole[at], size[at], np.minimum(size[at], self.last[s] - off[at]))
            for c, v in zip(cols, (at, np.full(len(at), ep), shard, draw, words)):
                c.append(v)
        out = [np.concatenate(c) for c in cols]
        order = np.lexsort((out[1], out[0]))
        return [c[order] for c in out]


def mix_sources(docs: DataFrame, carry: list[str], text: str = "text", source: str = "source", key: str = "doc_id",
                weights: list[float] | None = None, n_shards: int = N_SHARDS, block_words: int = BLOCK_WORDS,
                max_epochs: int = MAX_EPOCHS, seed: int = SEED, keep_sizes: bool = True) -> DataFrame:
    """One row for each row of ``docs``: ``carry``, size, source_size, target and draws
    (array of epoch, shard, draw, words taken from the start, position: hash by which
    the shard is ordered). ``keep_sizes`` writes the carried columns with the sizes
    once, instead of counting words twice (for narrow ``carry``)."""
    spark = docs.sparkSession
    clash = {"size", "source_size", "target", "draws"} & set(carry)
    if clash:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    base = docs.select(*carry, F.col(source).cast("string").alias("_source"), word_count(text).alias("size"),
                       F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(source).cast("string"), F.col(text)).alias("_h"))
    if keep_sizes:
        base = written(base, "sizes")
    totals = base.groupBy("_source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    plan = Plan([{"source": r["_source"], "size": r["size"], "docs": r["docs"]} for r in totals],
                weights, n_shards, block_words, max_epochs, seed)
    ids = spark.createDataFrame([(s, i, max(1, d // BIN_ROWS)) for i, (s, d) in enumerate(zip(plan.sources, plan.docs))],
                                "source string, _src int, _bins long")
    if len(plan.sources) <= 10_000:  # else Spark's own choice of join
        ids = F.broadcast(ids)

    def binned(df: DataFrame) -> DataFrame:
        u = F.shiftrightunsigned(F.col("_h"), 32)
        return df.join(ids, F.col("_source").eqNullSafe(F.col("source_name"))) \
            .withColumn("_bin", F.floor(u.cast("double") * F.col("_bins") / F.lit(float(1 << 32))).cast("long")) \
            .drop("source_name", "_bins", "_source")

    ids = ids.withColumnRenamed("source", "source_name")
    run = Window.partitionBy("_src").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = binned(base.select("_source", "_h", "size")).groupBy("_src", "_bin").agg(F.sum("size").alias("n")) \
        .select(F.col("_src").alias("_s"), F.col("_bin").alias("_b"), F.coalesce(F.sum("n").over(run), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_src", "_bin").orderBy("_h", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = binned(base).withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(bases, (F.col("_src") == F.col("_s")) & (F.col("_bin") == F.col("_b"))) \
        .select(*carry, "size", "_src", (F.col("_base") + F.col("_in")).alias("_off"))
    fields = [placed.schema[c] for c in carry]
    kind = pa.struct([("epoch", pa.int32()), ("shard", pa.int32()), ("draw", pa.int64()), ("words", pa.int64()),
                      ("position", pa.int64())])

    def deal(batches):
        sizes, targets = np.array(plan.size, np.int64), np.array(plan.target)
        for b in batches:
            c = len(fields)
            size, src, off = (b.column(c + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            row, ep, shard, draw, n = plan.draws(src, size, off)
            pos = mix(mix(shard.astype(U64) + U64(plan.seed)) + mix(draw.astype(U64) + (src[row].astype(U64) << U64(40))) + off[row].astype(U64))
            ends = np.searchsorted(row, np.arange(len(size) + 1))
            items = pa.StructArray.from_arrays([pa.array(ep.astype(np.int32)), pa.array(shard.astype(np.int32)), pa.array(draw),
                                                pa.array(n), pa.array(pos.view(np.int64))], fields=list(kind))
            draws = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)
            yield pa.RecordBatch.from_arrays([*b.columns[:c + 1], pa.array(sizes[src]), pa.array(targets[src]), draws],
                                             names=[*carry, "size", "source_size", "target", "draws"])

    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields], T.StructField("size", T.LongType()),
                           T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
                           T.StructField("draws", T._parse_datatype_string(DRAWS))])
    return map_arrow(placed, deal, schema)


def mixed_texts(mixed: DataFrame, text: str = "text", take: str = "take") -> DataFrame:
    """The rows of the mix: one for each ``take``, its text cut to the words taken."""
    rows = mixed.withColumn(take, F.explode("draws")).drop("draws")
    parts = F.regexp_extract_all(F.col(text), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(parts, 1, F.col(f"{take}.words").cast("int")), "")
    return rows.withColumn(text, F.when(F.col(f"{take}.words") < F.col("size"), cut).otherwise(F.col(text)))
