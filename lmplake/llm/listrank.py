"""Positions in a linked list that no single task could hold.

``rank`` takes one list as rows (id, succ), ids gapless from 0, succ -1 at the end, and
returns (id, pos). The list is contracted level by level:

* rows are dealt out in blocks of consecutive ids; a block links what it holds of the list
  into chains and keeps one row for each chain (its head, where the chain leaves to, its
  weight). Lists whose order follows their ids shrink to a few rows for each block at once.
* where that leaves more than ``SLOW`` of the rows, the list has no such order, and a round of
  random mating follows: a row whose coin is tails goes into its predecessor if that one's is
  heads, a quarter of the rows in expectation, whatever the list looks like.
* a list of one block ends the descent; positions go back down, a head's position plus the
  offset of the row in its chain.

Every level is a table in the shared folder; a task holds one block of ``BLOCK`` rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lmplake.llm.common import prepare, settled, u32, written

BLOCK = 1 << 15
SLOW = 0.6


def chains(first: int, succ: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows first, first+1, ... with their successors: index of each row's chain head,
    and the weight that stands before it in the chain."""
    m = len(succ)
    nxt = succ - first
    inside = (succ >= 0) & (nxt >= 0) & (nxt < m)
    back = np.arange(m)
    back[nxt[inside]] = np.flatnonzero(inside)
    offset = np.where(back == np.arange(m), 0, weight[back])
    while True:  # doubling: each step looks twice as far back
        far = back[back]
        if np.array_equal(far, back):
            return back, offset
        offset = offset + offset[back]
        back = far


def _contract(block: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, succ, w = (pdf[c].to_numpy(np.int64) for c in ("id", "succ", "w"))
        head, offset = chains(int(ids[0]), succ, w)
        is_head = head == np.arange(len(ids))
        nth = np.cumsum(is_head) - 1
        leave = np.full(len(ids), -1, np.int64)
        total = np.zeros(len(ids), np.int64)
        last = ~((succ >= ids[0]) & (succ <= ids[-1]))
        leave[head[last]], total[head[last]] = succ[last], offset[last] + w[last]
        return pd.DataFrame({"id": ids, "head": ids[head], "offset": offset, "block": ids // block, "nth": nth[head],
                             "leave": leave[head], "total": total[head]})
    return run


def _mate(items: DataFrame, level: int) -> DataFrame:
    """Rows that go into their predecessor: (id, head, offset), the others stand for themselves."""
    heads = lambda c: u32(F.lit(f"coin-{level}"), c) % 2 == 1
    gone = items.where(heads(F.col("id")) & (F.col("succ") >= 0) & ~heads(F.col("succ"))) \
        .select(F.col("succ").alias("id"), F.col("id").alias("head"), F.col("w").alias("offset"))
    return items.join(gone, "id", "left").select(
        "id", F.coalesce("head", "id").alias("head"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset"), "succ", "w")


def _renumber(kept: DataFrame, block: int) -> DataFrame:
    """(id, new): gapless numbers in the order of id, which is unique."""
    tagged = kept.select("id", F.floor(F.col("id") / block).cast("long").alias("b"))
    n = tagged.groupBy("b").count()
    base = n.select("b", F.coalesce(F.sum("count").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("base"))
    inside = Window.partitionBy("b").orderBy("id")
    return tagged.withColumn("r", F.row_number().over(inside) - 1).join(base, "b") \
        .select("id", (F.col("base") + F.col("r")).cast("long").alias("new"))


def rank(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, pos) for one list of rows (id, succ): pos counts from 0 at its head."""
    prepare(items.sparkSession)
    return settled(items.sparkSession, lambda: _rank(items, block), "positions")


def _rank(items: DataFrame, block: int) -> DataFrame:
    cur = written(items.select("id", "succ", F.lit(1).cast("long").alias("w")), "list")
    levels: list[tuple[DataFrame, DataFrame]] = []
    n, mating = cur.count(), False
    while True:
        if mating:
            members = written(_mate(cur, len(levels)), "members")
            kept = members.where("id = head")
            # a row that took its successor in goes on where that one went
            taken = members.where("id <> head").select(F.col("head").alias("id"), F.col("succ").alias("leave"), F.col("w").alias("more"))
            heads = kept.join(taken, "id", "left").select(
                "id", F.when(F.col("more").isNull(), F.col("succ")).otherwise(F.col("leave")).alias("leave"),
                (F.col("w") + F.coalesce("more", F.lit(0))).alias("total"))
            number = written(_renumber(kept, block), "numbers")
        else:
            members = written(cur.withColumn("b", F.floor(F.col("id") / block).cast("long")).groupBy("b").applyInPandas(
                _contract(block), "id long, head long, offset long, block long, nth long, leave long, total long"), "members")
            if n <= block:
                break
            heads = members.where("id = head")
            per = heads.groupBy("block").agg(F.count(F.lit(1)).alias("c"))
            base = per.select("block", F.coalesce(F.sum("c").over(
                Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
            number = written(heads.join(base, "block").select("id", (F.col("base") + F.col("nth")).cast("long").alias("new")), "numbers")
        out = heads.join(number, "id").select(F.col("new"), "leave", "total")
        to = number.select(F.col("id").alias("leave"), F.col("new").alias("to"))
        # the last chain leaves to -1, which is no id
        cur = written(out.join(to, "leave", "left").select(
            F.col("new").alias("id"), F.coalesce("to", F.lit(-1)).cast("long").alias("succ"), F.col("total").alias("w")), "list")
        levels.append((members, number))
        m = cur.count()
        mating, n = (not mating and m > SLOW * n), m
    pos = members.select("id", F.col("offset").alias("pos"))
    for members, number in reversed(levels):
        at = number.join(pos.withColumnRenamed("id", "new"), "new").select(F.col("id").alias("head"), "pos")
        pos = members.join(at, "head").select("id", (F.col("pos") + F.col("offset")).alias("pos"))
    return pos
