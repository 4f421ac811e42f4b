"""Raw page records -> typed price table (P1, C1-C6), with a quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmplake.feeds import RAW_NODE_FIELD, RAW_TIME_FIELD, FeedSpec
from lmplake.functions.time_cols import hour_ending, market_date, parse_utc_strict, parse_utc_tolerant


def price_columns(spec: FeedSpec, strict: bool = True) -> list[Column]:
    """The feed's seven output expressions: rename + cast of the raw fields."""
    parse = parse_utc_strict if strict else parse_utc_tolerant
    utc = parse(RAW_TIME_FIELD)
    cols = [
        utc.alias("utcbegin"),
        market_date(utc).alias("pricedate"),
        hour_ending(utc).alias("hour"),
        F.col(RAW_NODE_FIELD).try_cast("bigint").alias("node_id"),
    ]
    for raw, name in zip(spec.price_fields, spec.price_columns):
        cols.append(F.col(raw).try_cast("double").alias(name))
    return cols


def normalize_prices(raw: DataFrame, spec: FeedSpec, keep: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """Typed price table. ``keep`` passes bookkeeping columns through
    (pull id, ingest sequence). Strict mode raises on a malformed time, as
    the reference does; tolerant mode yields NULL (see ``quarantine``)."""
    return raw.select(*price_columns(spec, strict), *keep)


def quarantine_reason(spec: FeedSpec) -> Column:
    """Comma list of what is wrong with a raw record; NULL when it is clean.
    A NULL price is legal; a price that is present but not a number is not."""
    checks = [
        F.when(parse_utc_tolerant(RAW_TIME_FIELD).isNull(), F.lit("bad_time")),
        F.when(F.col(RAW_NODE_FIELD).try_cast("bigint").isNull(), F.lit("bad_node")),
    ]
    for raw in spec.price_fields:
        checks.append(
            F.when(F.col(raw).isNotNull() & F.col(raw).try_cast("double").isNull(), F.lit(f"bad_{raw}"))
        )
    reason = F.concat_ws(",", *checks)
    return F.when(reason != "", reason)


def split_quarantine(raw: DataFrame, spec: FeedSpec, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean typed rows, raw rows with a ``reason``). One expression drives
    both sides; callers persist ``raw`` if they materialise both."""
    tagged = raw.withColumn("reason", quarantine_reason(spec))
    good = normalize_prices(tagged.where(F.col("reason").isNull()), spec, keep, strict=False)
    bad = tagged.where(F.col("reason").isNotNull())
    return good, bad


def quarantine_summary(raw: DataFrame, spec: FeedSpec, group_cols: tuple[str, ...]) -> DataFrame:
    """Per group: rows seen, rows quarantined, and rows per failure kind."""
    r = quarantine_reason(spec)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count(r).alias("n_quarantined"),
        F.count(F.when(parse_utc_tolerant(RAW_TIME_FIELD).isNull(), 1)).alias("n_bad_time"),
        F.count(F.when(F.col(RAW_NODE_FIELD).try_cast("bigint").isNull(), 1)).alias("n_bad_node"),
        F.count(F.when(
            F.greatest(*[(F.col(p).isNotNull() & F.col(p).try_cast("double").isNull()).cast("int")
                         for p in spec.price_fields]) == 1, 1)).alias("n_bad_price"),
    ]
    return raw.groupBy(*group_cols).agg(*aggs)
