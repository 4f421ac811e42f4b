"""Feed registry: what each price feed looks like and how it advances.

A feed is a paged price API. Its spec says which raw fields a page carries,
how they are renamed and typed, the interval step, how far one request
reaches, and when the next interval is expected to be published. Specs are
plain Python values; every per-row computation they drive is a Column
expression (see ``lmplake.functions``), so nothing here runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# Feed names, raw field lists, target column names, steps, request spans,
# availability rules and the fallback delays when data is already due.
# ---------------------------------------------------------------------------
DA_FEED = "da_hrl_lmps"
RT_VERIFIED_FEED = "rt_fivemin_hrl_lmps"
RT_UNVERIFIED_FEED = "rt_unverified_fivemin_lmps"

RAW_TIME_FIELD = "datetime_beginning_utc"
RAW_NODE_FIELD = "pnode_id"
DA_PRICE_FIELDS = ("total_lmp_da", "congestion_price_da", "marginal_loss_price_da")
RT_PRICE_FIELDS = ("total_lmp_rt", "congestion_price_rt", "marginal_loss_price_rt")
DA_PRICE_COLUMNS = ("dalmp", "damcc", "damcl")
RT_PRICE_COLUMNS = ("rtlmp", "rtmcc", "rtmcl")

PAGE_SIZE = 50_000                 # rows per API page
DA_SPAN_HOURS = 23                 # day-ahead request reaches begin + 24 h - 1 h
DA_LEAD_HOURS = 14                 # day-ahead expected at begin - 14 h
DA_PAST_DELAY_SECS = 60            # day-ahead delay when already due
RT_PAST_DELAY_SECS = 0             # real-time delay when already due
VERIFIED_PUBLISH_HOUR = 10         # verified data: next business day 10:00 New York
UNVERIFIED_LAG_MINUTES = 5         # unverified data: begin + 5 min

MARKET_TZ = "America/New_York"
# ---------------------------------------------------------------------------

KEY_COLUMNS = ("node_id", "utcbegin")


@dataclass(frozen=True)
class FeedSpec:
    name: str
    price_fields: tuple[str, str, str]
    price_columns: tuple[str, str, str]
    step_minutes: int
    span_minutes: int | None          # None: civil-day span (begin + 23 h)
    availability: str                 # "lead" | "next_business_day" | "lag"
    past_delay_secs: int
    row_is_current: bool
    serving_target: str               # "da" | "rt"

    @property
    def step(self) -> timedelta:
        return timedelta(minutes=self.step_minutes)

    @property
    def is_sub_daily(self) -> bool:
        return self.step_minutes < 24 * 60

    @property
    def api_fields(self) -> tuple[str, ...]:
        return (RAW_TIME_FIELD, RAW_NODE_FIELD, *self.price_fields)

    @property
    def request_span_minutes(self) -> int:
        return self.span_minutes if self.span_minutes is not None else DA_SPAN_HOURS * 60

    def raw_schema(self) -> T.StructType:
        """Explicit page schema. Every field is read as text so that a bad
        value is caught by a tolerant cast (quarantine) instead of failing
        the whole read; numbers in JSON keep their literal text."""
        return T.StructType([T.StructField(f, T.StringType(), True) for f in self.api_fields])

    def price_schema(self) -> T.StructType:
        fields = [
            T.StructField("utcbegin", T.TimestampNTZType(), True),
            T.StructField("pricedate", T.DateType(), True),
            T.StructField("hour", T.IntegerType(), True),
            T.StructField("node_id", T.LongType(), True),
        ]
        fields += [T.StructField(c, T.DoubleType(), True) for c in self.price_columns]
        return T.StructType(fields)


FEEDS: dict[str, FeedSpec] = {
    DA_FEED: FeedSpec(
        name=DA_FEED,
        price_fields=DA_PRICE_FIELDS,
        price_columns=DA_PRICE_COLUMNS,
        step_minutes=60,
        span_minutes=None,
        availability="lead",
        past_delay_secs=DA_PAST_DELAY_SECS,
        row_is_current=True,
        serving_target="da",
    ),
    RT_VERIFIED_FEED: FeedSpec(
        name=RT_VERIFIED_FEED,
        price_fields=RT_PRICE_FIELDS,
        price_columns=RT_PRICE_COLUMNS,
        step_minutes=5,
        span_minutes=10,
        availability="next_business_day",
        past_delay_secs=RT_PAST_DELAY_SECS,
        row_is_current=True,
        serving_target="rt",
    ),
    RT_UNVERIFIED_FEED: FeedSpec(
        name=RT_UNVERIFIED_FEED,
        price_fields=RT_PRICE_FIELDS,
        price_columns=RT_PRICE_COLUMNS,
        step_minutes=5,
        span_minutes=10,
        availability="lag",
        past_delay_secs=RT_PAST_DELAY_SECS,
        row_is_current=False,
        serving_target="rt",
    ),
}


class UnknownFeed(ValueError):
    pass


def feed(name: str) -> FeedSpec:
    try:
        return FEEDS[name]
    except KeyError:
        raise UnknownFeed(name) from None


def feed_names() -> list[str]:
    return list(FEEDS)
