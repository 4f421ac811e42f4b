"""Control messages: decode incoming work items, encode next-work items.

Two message kinds exist. A *fetch* message names a feed and the UTC start of
the interval to pull; a *merge* message names a feed and a market day whose
landed rows are to be merged into the day table. Either may arrive as plain
JSON or wrapped in quotes with escaped inner quotes. Decoding tries fetch
first, then merge; anything else is ``bad`` and goes to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lmplake.feeds import FEEDS
from lmplake.functions.time_cols import _c, iso_utc_text, parse_iso_offset

# ---------------------------------------------------------------------------
# Field names of the two message kinds (wire format).
# fetch: begin time with offset, feed name, continue flag; merge: day, feed name.
BEGIN_FIELD, FEED_FIELD, NEXT_FIELD = "begin_time_iso_str", "pjm_end_point", "queue_next"
DATE_FIELD, ENDPOINT_FIELD = "date", "endpoint"
# queue envelope: {"Data": {name: value}, "Metadata": ...}; the value is the message
ENVELOPE_DATA = "Data"
# ---------------------------------------------------------------------------

FETCH_SCHEMA = T.StructType([
    T.StructField(BEGIN_FIELD, T.StringType()),
    T.StructField(FEED_FIELD, T.StringType()),
    T.StructField(NEXT_FIELD, T.BooleanType()),
])
MERGE_SCHEMA = T.StructType([
    T.StructField(DATE_FIELD, T.StringType()),
    T.StructField(ENDPOINT_FIELD, T.StringType()),
])

DECODED_COLUMNS = ("kind", "feed", "begin_utc", "queue_next", "merge_date")


def unwrap_quoted(text: Column | str) -> Column:
    """Strip one pair of surrounding quotes, then unescape inner quotes.
    One regex keeps the input referenced once, so an upstream expression is
    never copied into several branches."""
    inner = F.regexp_replace(_c(text), r'(?s)^"(.*)"$', "$1")
    return F.replace(inner, F.lit('\\"'), F.lit('"'))


def open_envelope(text: Column | str) -> Column:
    """The message inside a queue envelope (the first value of its ``Data`` map);
    text that is no envelope stays as it is."""
    data = F.try_variant_get(F.try_parse_json(_c(text)), f"$.{ENVELOPE_DATA}", "map<string,string>")
    return F.coalesce(F.try_element_at(F.map_values(data), F.lit(1)), _c(text))


# Both message kinds parsed in one pass: serde ignores unknown fields, so a
# fetch decode and a merge decode of the same text see the same values.
MESSAGE_SCHEMA = T.StructType([*FETCH_SCHEMA.fields, *MERGE_SCHEMA.fields])


def decode_messages(df: DataFrame, text_col: str = "value", envelope: bool = False) -> DataFrame:
    """Append ``kind, feed, begin_utc, queue_next, merge_date`` to ``df``.

    Fetch is tried first (all three fields, a known feed, a parseable begin
    time); then merge (an endpoint and a day that parses); anything else is bad.
    ``envelope`` takes messages out of their queue envelope first."""
    text = open_envelope(text_col) if envelope else text_col
    parsed = df.withColumn("_m", F.from_json(unwrap_quoted(text), MESSAGE_SCHEMA))
    m = lambda f: F.col("_m").getField(f)
    begin = parse_iso_offset(m(BEGIN_FIELD))
    is_fetch = m(NEXT_FIELD).isNotNull() & m(FEED_FIELD).isin(list(FEEDS)) & begin.isNotNull()
    day = F.try_to_date(m(DATE_FIELD), "yyyy-MM-dd")
    is_merge = F.col("_d").isNotNull() & m(ENDPOINT_FIELD).isNotNull()
    code = F.when(is_fetch, F.lit(1)).when(is_merge, F.lit(2)).otherwise(F.lit(0))
    staged = parsed.withColumn("_d", day).withColumn("_k", code).withColumn("_b", begin)
    k = F.col("_k")
    return staged.select(
        *df.columns,
        F.element_at(F.array(F.lit("bad"), F.lit("fetch"), F.lit("merge")), k + 1).alias("kind"),
        F.when(k == 1, m(FEED_FIELD)).when(k == 2, m(ENDPOINT_FIELD)).alias("feed"),
        F.when(k == 1, F.col("_b")).alias("begin_utc"),
        F.when(k == 1, m(NEXT_FIELD)).alias("queue_next"),
        F.when(k == 2, F.col("_d")).alias("merge_date"),
    )


def rejected_messages(decoded: DataFrame, configured: list[str]) -> DataFrame:
    """What a worker can't act on: undecodable messages, and those for feeds that it
    has no transport for.

    A row is filtered as an element of an array of its own: a filter on a decoded column would be pushed below the
    decode, where each mention of ``kind`` or ``feed`` is another parse of the message."""
    bad = lambda r: (r["kind"] == "bad") | ~F.coalesce(r["feed"].isin(configured), F.lit(False))
    kept = F.filter(F.array(F.struct(*decoded.columns)), bad)
    return decoded.select(F.explode(kept).alias("_r")).select("_r.*")


def fetch_message_json(begin_utc: Column | str, feed_col: Column | str, queue_next: Column | bool = True) -> Column:
    qn = queue_next if isinstance(queue_next, Column) else F.lit(bool(queue_next))
    return F.to_json(F.struct(
        iso_utc_text(begin_utc).alias(BEGIN_FIELD),
        _c(feed_col).alias(FEED_FIELD),
        qn.alias(NEXT_FIELD),
    ))


def merge_message_json(day: Column | str, feed_col: Column | str) -> Column:
    return F.to_json(F.struct(
        _c(day).cast("string").alias(DATE_FIELD),
        _c(feed_col).alias(ENDPOINT_FIELD),
    ))


def base64_text(text: Column) -> Column:
    """Standard base64 of the UTF-8 bytes, one line (MIME line breaks removed)."""
    return F.regexp_replace(F.base64(text.cast("binary")), r"[\r\n]", "")


def queue_name(feed_col: Column | str) -> Column:
    return F.replace(_c(feed_col), F.lit("_"), F.lit(""))
