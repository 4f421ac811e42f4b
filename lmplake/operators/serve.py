"""Serving table for known assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lmplake.feeds import FeedSpec
from lmplake.operators.merge import latest_wins, merge_order

# The known assets of the serving table (node id -> label).
ASSETS = (
    (2156110049, "fern"),
    (45565887, "camden"),
    (35010337, "dom"),
)
# The asset list is configuration and is broadcast up to this size; a longer one is
# joined like any table.
MAX_BROADCAST_ASSETS = 100_000

ASSET_SCHEMA = T.StructType([
    T.StructField("node_id", T.LongType(), False),
    T.StructField("node", T.StringType(), False),
])


def asset_dimension(spark: SparkSession, assets=ASSETS) -> DataFrame:
    assets = [(int(n), str(lbl).strip('"')) for n, lbl in assets]
    df = spark.createDataFrame(assets, ASSET_SCHEMA)
    if len(assets) <= MAX_BROADCAST_ASSETS:
        df._lmplake_bounded_rows = len(assets)  # size checked: safe to broadcast
    return df


def serving_columns(spec: FeedSpec) -> list[str]:
    return ["node", "utcbegin", "pricedate", "hour", *spec.price_columns]


def serving_schema(spec: FeedSpec, seq_col: str = "ingest_seq") -> T.StructType:
    fields = [T.StructField("node", T.StringType()), T.StructField("utcbegin", T.TimestampNTZType()),
              T.StructField("pricedate", T.DateType()), T.StructField("hour", T.IntegerType())]
    fields += [T.StructField(c, T.DoubleType()) for c in spec.price_columns]
    return T.StructType([*fields, T.StructField(seq_col, T.LongType())])


def asset_lookup(prices: DataFrame, assets: DataFrame, spec: FeedSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of known assets, labelled, in serving column order; the inner
    join is the ``IN`` filter. A dimension built by ``asset_dimension`` has a
    checked row count and is broadcast explicitly; any other frame is left to
    AQE's run-time size check."""
    dim = F.broadcast(assets) if getattr(assets, "_lmplake_bounded_rows", None) is not None else assets
    return prices.join(dim, "node_id", "inner").select(*serving_columns(spec), *keep)


def asset_upsert(serving: DataFrame | None, batch: DataFrame, spec: FeedSpec, seq_col: str = "ingest_seq",
                 policy: str = "arrival") -> DataFrame:
    """``INSERT ... ON CONFLICT (node, utcbegin) DO UPDATE`` as a DataFrame:
    batch rows replace serving rows of the same key (``arrival``), or the
    largest ``seq_col`` wins wherever it is (``sequence``, for streams whose
    sequences are stamped at landing); duplicate keys inside the batch
    resolve to the largest ``seq_col``; an empty batch changes nothing."""
    cols = [*serving_columns(spec), seq_col]
    rank_new = 1 if policy == "arrival" else 0
    new = batch.select(*cols).withColumn("_ord", merge_order(rank_new, seq_col))
    if serving is not None:
        new = serving.select(*cols).withColumn("_ord", merge_order(0, seq_col)).unionByName(new)
    return latest_wins(new, ["node", "utcbegin"], "_ord").drop("_ord").select(*cols)
