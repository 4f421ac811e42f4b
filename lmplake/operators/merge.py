"""Latest-wins merge of landed rows into market-day tables.

Merge order is one fixed-width BIGINT so the dedupe stays a hash aggregate
with map-side partial aggregation (one ``max_by`` per value column): a key
that repeats a million times is combined before the shuffle.

``arrival`` policy (the reference's): every new row beats every existing row
of its key; among new rows the larger ``ingest_seq`` wins. ``sequence``
policy: the larger ``ingest_seq`` wins wherever the row came from, which
makes merges commutative.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmplake.feeds import KEY_COLUMNS

SEQ_COL = "ingest_seq"
_RANK_SHIFT = 1 << 62  # src_rank occupies the bits above any ingest_seq


def merge_order(src_rank: Column | int, seq: Column | str = SEQ_COL) -> Column:
    r = src_rank if isinstance(src_rank, Column) else F.lit(int(src_rank))
    s = F.col(seq) if isinstance(seq, str) else seq
    return r.cast("bigint") * F.lit(_RANK_SHIFT) + s.cast("bigint")


def latest_wins(df: DataFrame, key_cols: list[str] | tuple[str, ...] = KEY_COLUMNS,
                order_col: str = SEQ_COL, value_cols: list[str] | None = None) -> DataFrame:
    """One row per key: the values of the row with the largest ``order_col``.
    ``order_col`` must be non-NULL and unique per key. With fixed-width value
    columns (numbers, dates, timestamps) this plans as a hash aggregate with
    map-side partial aggregation; a string value column turns it into a sort
    aggregate, so keep text out of the merged tables."""
    key_cols = list(key_cols)
    if value_cols is None:
        value_cols = [c for c in df.columns if c not in key_cols and c != order_col]
    aggs = [F.max_by(c, order_col).alias(c) for c in value_cols]
    aggs.append(F.max(order_col).alias(order_col))
    return df.groupBy(*key_cols).agg(*aggs).select(*df.columns)


def merge_rows(existing: DataFrame, new: DataFrame, key_cols=KEY_COLUMNS, seq_col: str = SEQ_COL,
               policy: str = "arrival") -> DataFrame:
    """Existing day rows ∪ new rows -> latest wins per key. Output keeps the
    input columns; ``seq_col`` is the winning row's own sequence."""
    cols = existing.columns
    new = new.select(*cols)
    if policy == "sequence":
        return latest_wins(existing.unionByName(new), key_cols, seq_col)
    if policy != "arrival":
        raise ValueError(policy)
    tagged = existing.withColumn("_ord", merge_order(0, seq_col)).unionByName(
        new.withColumn("_ord", merge_order(1, seq_col)))
    return latest_wins(tagged, key_cols, "_ord").drop("_ord")


def touched_days(new: DataFrame, day_col: str = "pricedate") -> DataFrame:
    return new.select(day_col).distinct()


def carried_over_nodes(existing: DataFrame, new: DataFrame, day_col: str = "pricedate",
                       part_cols: tuple[str, ...] = ()) -> DataFrame:
    """Nodes present in an existing day that get no new row that day."""
    keys = [*part_cols, day_col, "node_id"]
    old_nodes = existing.select(*keys).distinct()
    new_nodes = new.select(*keys).distinct()
    return old_nodes.join(new_nodes, keys, "left_anti")


def node_inventory(day_table: DataFrame, day_col: str = "pricedate", part_cols: tuple[str, ...] = ()) -> DataFrame:
    """Distinct nodes per day, read from the ``node_id`` column only."""
    return day_table.select(*part_cols, day_col, "node_id").distinct()


def relative_path(path: Column | str, root: str) -> Column:
    """Strip a store prefix (``root/``) from a path column (C21); paths under
    another root are returned unchanged."""
    import re
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(p, "^" + re.escape(root.rstrip("/")) + "/", "")


def input_manifest(landed: DataFrame, file_col: str = "file_path", day_col: str = "pricedate",
                   part_cols: tuple[str, ...] = (), root: str | None = None) -> DataFrame:
    """Per day and source file: rows, first and last interval; with ``root``
    also the file path relative to it."""
    out = landed.groupBy(*part_cols, day_col, file_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("utcbegin").alias("first_utcbegin"),
        F.max("utcbegin").alias("last_utcbegin"),
    )
    if root is not None:
        out = out.withColumn("rel_path", relative_path(file_col, root))
    return out


def unprocessed_inputs(files: DataFrame, ledger: DataFrame, file_col: str = "file_path") -> DataFrame:
    """Landed files not yet recorded as merged."""
    return files.join(ledger.select(file_col).distinct(), file_col, "left_anti")


# A list longer than this becomes a frame and a semi-join instead of a literal filter.
MAX_LITERAL_NODES = 10_000


def node_day_lookup(day_table: DataFrame, nodes, days=None, day_col: str = "pricedate") -> DataFrame:
    """Rows of the given nodes (optionally on given days).

    ``nodes`` as a short Python list becomes a literal ``IN`` filter that
    Catalyst pushes to the Parquet scan (row groups of other nodes are
    skipped, since day files are sorted by node). A ``DataFrame`` of node ids
    has no proven bound, so it is a semi-join and AQE picks broadcast or
    shuffle from its actual size."""
    out = day_table
    if days is not None:
        out = out.where(F.col(day_col).isin(list(days)))
    if isinstance(nodes, DataFrame):
        # no distinct(): a semi-join ignores duplicates on its right side, and
        # a plain (non-aggregated) right side keeps AQE's skew split available
        keys = [c for c in nodes.columns if c in ("node_id", day_col)]
        return out.join(nodes.select(*keys), keys, "left_semi")
    nodes = [int(n) for n in nodes]
    if len(nodes) > MAX_LITERAL_NODES:
        frame = day_table.sparkSession.createDataFrame([(n,) for n in nodes], "node_id bigint")
        return out.join(frame, "node_id", "left_semi")
    return out.where(F.col("node_id").isin(nodes))
