"""Attach per-group values (minimum, width, ...) to every row of a group
without sending a heavy group to one task.

Joining rows back to an aggregate of themselves is the risky pattern: the
aggregate side keeps its hash partitioning on the group key, the join reuses
it, and AQE's skew-join split does not apply to such a side (measured: a
plain table side is split, an aggregate-of-the-same-data side is not). So a
group holding a third of the rows would be joined in one task.

Here the groups are split by size. With ``total`` rows and at most
``max_heavy`` heavy groups allowed, a group is heavy when it has more than
``total / max_heavy`` rows - at most ``max_heavy`` groups can, so the heavy
side has a proven size bound and is broadcast (no shuffle of the big side).
Every light group has at most ``total / max_heavy`` rows, so the ordinary
shuffle join (or AQE's broadcast, when small) is safe for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmplake.session import reliable_checkpoint

MAX_HEAVY_GROUPS = 10_000


def attach_group_stats(df: DataFrame, stats: DataFrame, group_cols: list[str], join_cols: list[str] | None = None,
                       how: str = "inner", count_col: str = "_cnt", max_heavy: int = MAX_HEAVY_GROUPS) -> DataFrame:
    """``df ⋈ stats`` on ``join_cols`` (default ``group_cols``), heavy groups by
    broadcast. ``stats`` has one row per ``join_cols`` key and a row count per
    group in ``count_col``; it is checkpointed (it is small) because its total
    decides the split and both branches read it."""
    join_cols = join_cols or group_cols
    stats = reliable_checkpoint(stats)
    total = stats.agg(F.sum(count_col)).first()[0] or 0
    threshold = max(1, -(-int(total) // max_heavy))
    heavy = stats.where(F.col(count_col) > F.lit(threshold)).drop(count_col)
    light = stats.where(F.col(count_col) <= F.lit(threshold)).drop(count_col)
    heavy_keys = F.broadcast(heavy.select(*group_cols).distinct())
    heavy_rows = _null_safe(df, F.broadcast(heavy), join_cols, how)
    light_rows = _null_safe(_null_safe(df, heavy_keys, group_cols, "left_anti"), light, join_cols, how)
    return heavy_rows.unionByName(light_rows)


def _null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """``left.join(right, cols, how)`` where a NULL key equals a NULL key, as it does in
    the aggregate that made the right side."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    on = F.lit(True)
    for c in cols:
        on = on & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in cols])
