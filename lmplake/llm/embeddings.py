"""Near-duplicate vectors by collision-counting projections.

Vectors are scaled to length 1, projected on ``tables * dims`` random directions, and
two vectors collide on a projection when they lie in each other's window: at most
``window`` apart. The count of a pair's collisions is binomial with a known chance for
vectors at the threshold, so the least count that a pair needs is calibrated for the
wanted recall; pairs with that count are verified by cosine in double precision.

Which pairs are counted: the projections are grouped by ``dims`` to a table, and in each
table the vectors are sorted by the cells (of ``cell`` windows' width, with a random
offset) of its projections; vectors that share all cells of some table meet. The number
of tables is set so that pairs at the threshold meet in one of them with the wanted
recall, the number of dims grows with the logarithm of the row count, so that a vector
meets about as many strangers at any size. Collisions are counted on ``COUNTED`` of
the projections.

A pair that meets in several tables is looked at in the first of them only (the keys of
all tables are a function of the vector), so links are counted once. Vectors that are
equal in all components are one vector with a weight. A task compares the vectors of a
cell as matrices and gives out, for each vector, its number of links, and a spanning
forest; no pair is ever a row. Cells beyond ``BLOCK`` vectors are cut into blocks and
dealt out as pairs of blocks, so no cell is one task's work and none is capped.

Vectors of each length are a table of their own: they have their own directions, number
of tables and cells, and all lengths go through the same tasks.

Defined cases: a vector that is null, zero, or with a null or non-finite component
links with nothing, not even its equals; vectors of different lengths don't link. A
null vec_id counts as a neighbour and has no component. Rows that repeat vec_id are
separate rows of one component. An empty table gives no row.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import U64, map_arrow, mix, prepare, written
from lmplake.llm.graph import components
from lmplake.llm.minhash import forest, grouped

THRESHOLD = 0.95
RECALL = 0.97
CELL = 1.5
COUNTED = 64
SMALL = 8
BLOCK = 2048
SEED = 8


class Projections:
    """Directions, offsets, number of tables, and the count that a pair needs."""

    def __init__(self, size: int, rows: int, threshold: float, recall: float, seed: int = SEED, cell: float = CELL):
        from math import erf, exp, log, pi, sqrt

        def share(sd: float) -> float:  # chance of one cell for a difference with that deviation
            x = cell / sd
            return erf(x / sqrt(2)) - 2 / (sqrt(2 * pi) * x) * (1 - exp(-x * x / 2))

        near = sqrt(2 - 2 * threshold)
        self.dims = max(2, round(log(4 * max(rows, 2)) / -log(share(sqrt(2)))))
        p = max(share(near), 1e-9) ** self.dims
        self.tables = max(1, int(np.ceil(log(1 - recall) / log(1 - p)))) if p < 1 else 1
        self.cell, self.size = cell, size
        rng = np.random.default_rng([seed, size])
        n = self.dims * self.tables
        self.directions = rng.normal(size=(size, n))
        self.offsets = rng.random(n) * cell
        # a window of two deviations, and the count that all but 1e-4 of the pairs at the threshold have
        self.window, self.counted = 2 * near, min(n, COUNTED)
        chance = erf(2 / sqrt(2))
        self.least = max(0, int(self.counted * chance - 3.72 * sqrt(self.counted * chance * (1 - chance)) - 1))

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.directions

    def keys(self, proj: np.ndarray) -> np.ndarray:
        """One 64-bit key for each table: the cells of its projections."""
        cells = np.floor((proj + self.offsets) / self.cell).astype(np.int64).view(U64).reshape(len(proj), self.tables, self.dims)
        out = np.zeros((len(proj), self.tables), U64) + np.arange(1, self.tables + 1, dtype=U64)
        for d in range(self.dims):
            out = mix(out * U64(0x9FB21C651E98DF25) + cells[:, :, d])
        return out


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """(key, n_links, component_id, kept) for each row of ``vectors``."""
    prepare(vectors.sparkSession)
    v = F.col("v")
    element = vectors.schema[vector].dataType.elementType
    # one zero: grouping takes -0.0 and 0.0 as equal, a hash doesn't
    rows = vectors.select(F.col(key).alias("key"), F.transform(
        F.col(vector), lambda x: F.when(x == 0, F.lit(0).cast(element)).otherwise(x)).alias("v"))
    usable = F.coalesce(v.isNotNull() & (F.size(v) > 0)
                        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", usable)
    none = rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"),
                       F.col("key").isNotNull().alias("kept"))
    # equal vectors are one, with a weight
    distinct = written(rows.where("good").groupBy("v").agg(F.count(F.lit(1)).alias("weight"), F.min("key").alias("rep"))
                       .withColumn("node", F.xxhash64("v")), "vectors")
    counts = {r["size"]: r["count"] for r in distinct.groupBy(F.size("v").alias("size")).count().collect()}
    if not counts:
        return none

    def spread(batches):
        projections = lru_cache(16)(lambda n: Projections(n, counts[n], threshold, recall, seed))
        for b in batches:
            length = np.asarray(b.column(2).value_lengths())
            for size in np.unique(length).tolist():
                if counts[size] < 2:
                    continue
                c, proj = b.take(pa.array(np.flatnonzero(length == size))), projections(size)
                x = unit(c.column(2).flatten().to_numpy().astype(np.float64).reshape(-1, size))
                keys = proj.keys(proj.project(x)).view(np.int64)
                at = pa.array(np.repeat(np.arange(len(x)), proj.tables))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(keys.size, size, np.int32)), pa.array(keys.ravel()),
                                                  c.column(0).take(at)], names=["size", "cell", "node"])

    cells = written(map_arrow(distinct.select("node", "weight", "v"), spread, "size int, cell bigint, node bigint"), "cells")
    met = cells.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cut = cells.join(met, ["size", "cell"]).withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = cut.select("size", "cell", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "node") \
        .join(distinct.select("node", "weight", "v"), "node") \
        .repartition("size", "cell", "lo", "hi").sortWithinPartitions("size", "cell", "lo", "hi", "node") \
        .select("size", "cell", "lo", "hi", "node", "weight", "chunk", "v")

    def pairs(t, starts, proj):
        node, weight, chunk, cell, lo, hi = (t.column(c).to_numpy() for c in ("node", "weight", "chunk", "cell", "lo", "hi"))
        x = unit(t.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, proj.size))
        p = proj.project(x)
        keys = proj.keys(p).view(np.int64)
        p = np.ascontiguousarray(p[:, :proj.counted])
        links = np.zeros(len(node), np.int64)

        def checked(i: np.ndarray, j: np.ndarray, counted: bool) -> np.ndarray:
            """Which of the pairs collide often enough, meet here first, and are near."""
            good = np.zeros(len(i), bool)
            for q in range(0, len(i), 1 << 14):
                m, n = i[q:q + (1 << 14)], j[q:q + (1 << 14)]
                ok = np.arange(len(m))
                if not counted:
                    ok = np.flatnonzero((np.abs(p[m] - p[n]) <= proj.window).sum(axis=1) >= proj.least)
                    m, n = m[ok], n[ok]
                same = keys[m] == keys[n]
                here = keys[m, same.argmax(axis=1)] == cell[m]
                good[q + ok] = here & (np.einsum("ij,ij->i", x[m], x[n]) >= threshold)
            return good

        size, heads, a, b = np.diff(starts), starts[:-1], [], []
        for n in range(2, SMALL + 1):  # the many small cells, all of a size at once
            u, w = np.triu_indices(n, 1)
            at = heads[(size == n) & (lo[heads] == hi[heads])]
            i, j = (at[:, None] + u).ravel(), (at[:, None] + w).ravel()
            good = checked(i, j, False)
            a.append(i[good])
            b.append(j[good])
            np.add.at(links, i[good], weight[j[good]])
            np.add.at(links, j[good], weight[i[good]])
        for s, e in zip(heads, starts[1:]):
            if e - s <= SMALL and lo[s] == hi[s]:
                continue
            count = np.zeros((e - s, e - s), np.uint8)
            for c in range(proj.counted):
                count += np.abs(p[s:e, c][:, None] - p[s:e, c][None, :]) <= proj.window
            enough = np.triu(count >= proj.least, 1)
            if lo[s] != hi[s]:  # two blocks: pairs across them only
                enough &= chunk[s:e][:, None] != chunk[s:e][None, :]
            i, j = np.nonzero(enough)
            good = checked(s + i, s + j, True)
            i, j = i[good], j[good]
            np.add.at(links, s + i, weight[s + j])
            np.add.at(links, s + j, weight[s + i])
            linked = np.zeros((e - s, e - s), bool)
            linked[i, j] = linked[j, i] = True
            f, g = forest(linked)
            a.append(s + f)
            b.append(s + g)
        a, b = np.concatenate(a), np.concatenate(b)
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([node[some], node[a]])), pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)])),
             pa.array(np.concatenate([node[some], node[b]]))], names=["node", "links", "to"])

    def compare(batches):
        projections = lru_cache(16)(lambda n: Projections(n, counts[n], threshold, recall, seed))
        for all_sizes, group_starts in grouped(batches, 4):
            of = all_sizes.column("size").to_numpy()[group_starts[:-1]]
            for size in np.unique(of).tolist():  # sorted by size, so each has one range
                g = np.flatnonzero(of == size)
                starts = group_starts[g[0]:g[-1] + 2]
                yield pairs(all_sizes.slice(starts[0], starts[-1] - starts[0]), starts - starts[0], projections(size))

    found = written(map_arrow(dealt, compare, "node bigint, links bigint, to bigint"), "links")
    links = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    group = components(found.where("links = 0"), "node", "to")
    # components are named after their smallest vec_id
    named = written(distinct.select("node", "rep").join(group, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")), "named")
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    facts = distinct.select("node", "weight").join(links, "node", "left").join(named.select("node", "component"), "node") \
        .join(names, "component").select("node", "component_id",
                                         (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.withColumn("node", F.when(F.col("good"), F.xxhash64("v"))).select("key", "node").join(facts, "node", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("key"), F.lit(False)).alias("kept"))
