"""Connected components of an edge table, by alternating star contraction.

Every round joins and aggregates the edge table. No neighbour list is ever
collected: a hub with a third of all edges is one row of a partial aggregate, which
is broadcast to its edges (``join_sized``). Rounds are written to the shared folder.
Stops when a round changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.llm.common import join_sized, written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
    return tuple(r)


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Connect each node's larger (or its smaller) neighbours to its smallest one."""
    n = F.count(F.lit(1)).alias("n")
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), n)
        out = join_sized(both.where("v > u"), low, ["u"], "n", 2 * total, "inner") \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"), n)
        out = join_sized(edges, low, ["u"], "n", total, "inner").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each node of an edge can reach.
    Null ends and self-loops are ignored; nodes without an edge have no row."""
    cur = edges.select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    cur = written(cur, "edges")
    state = _state(cur)
    while True:
        # edges always point from the larger node u to the smaller node v
        mid = written(_star(cur, True, state[0]), "star")
        cur = written(_star(mid, False, state[0]), "star")
        now = _state(cur)
        if now == state:
            break
        state = now
    own = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
