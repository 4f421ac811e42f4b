"""Session-independent time columns.

UTC instants are kept as ``TIMESTAMP_NTZ`` holding UTC wall time, so no
result depends on ``spark.sql.session.timeZone``. Market-local values go
through ``convert_timezone`` with both zones named. Truncation and text
formatting use field arithmetic and the NTZ string form, never
``date_trunc``/``date_format`` (those are session-zone sensitive on NTZ).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lmplake.feeds import MARKET_TZ

# The raw time text format of the price API (strict, exact).
RAW_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
_RAW_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
# Message begin times: yyyy-MM-ddTHH:mm:ss followed by a +HHMM / -HHMM offset.
_ISO_OFFSET_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9][+-][0-9]{4}$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_utc_strict(text: Column | str) -> Column:
    """Raw API time text -> UTC NTZ. Raises on any malformed value (ANSI)."""
    return F.to_timestamp_ntz(_c(text), F.lit(RAW_TIME_FORMAT))


def raw_time_is_valid(text: Column | str) -> Column:
    t = _c(text)
    return t.rlike(_RAW_TIME_PATTERN) & F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd").isNotNull()


def parse_utc_tolerant(text: Column | str) -> Column:
    """Raw API time text -> UTC NTZ, NULL when malformed (for quarantine).

    The strict parser only sees text that is already known to be valid, so it
    never raises; the result is the same type as the strict form."""
    t = _c(text)
    return F.when(raw_time_is_valid(t), F.to_timestamp_ntz(t, F.lit(RAW_TIME_FORMAT)))


def market_local(utc: Column | str) -> Column:
    """UTC NTZ -> New York wall time (NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(MARKET_TZ), _c(utc))


def market_date(utc: Column | str) -> Column:
    return F.to_date(market_local(utc))


def hour_ending(utc: Column | str) -> Column:
    """New York hour ending, 1..24 (repeated on the autumn change day)."""
    return (F.hour(market_local(utc)) + F.lit(1)).cast("int")


def market_midnight_utc(day: Column | str) -> Column:
    """UTC instant of New York midnight starting ``day`` (DATE)."""
    return F.convert_timezone(F.lit(MARKET_TZ), F.lit("UTC"), _c(day).cast("timestamp_ntz"))


def market_time_utc(day: Column | str, hours: int) -> Column:
    """UTC instant of New York wall time ``day`` + ``hours``:00."""
    local = F.timestamp_add("HOUR", F.lit(hours), _c(day).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit(MARKET_TZ), F.lit("UTC"), local)


def add_minutes(ts: Column | str, minutes: int | Column) -> Column:
    m = minutes if isinstance(minutes, Column) else F.lit(int(minutes))
    return F.timestamp_add("MINUTE", m, _c(ts))


def floor_to_step(ts: Column | str, step_minutes: int) -> Column:
    """Truncate an NTZ instant to a step that divides a day (5 min, 1 h, 1 d).

    Field arithmetic keeps the type NTZ and is independent of the session zone,
    unlike ``date_trunc``; unlike ``window()`` it keeps NULL rows."""
    t = _c(ts)
    if step_minutes == 24 * 60:
        return F.to_date(t).cast("timestamp_ntz")
    if step_minutes % 60 == 0 and (24 * 60) % step_minutes == 0:
        hours = step_minutes // 60
        h = F.hour(t) - F.hour(t) % F.lit(hours)
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), h, F.lit(0), F.lit(0))
    if 60 % step_minutes == 0:
        m = F.minute(t) - F.minute(t) % F.lit(step_minutes)
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), m, F.lit(0))
    raise ValueError(f"step of {step_minutes} minutes does not divide an hour or a day")


def _ntz_text(ts: Column | str) -> Column:
    # The string form of NTZ is zone-free: 'yyyy-MM-dd HH:mm:ss[.ffffff]'.
    return _c(ts).cast("string")


def raw_time_text(ts: Column | str) -> Column:
    """NTZ -> 'yyyy-MM-ddTHH:mm:ss' (the API's raw time text)."""
    s = _ntz_text(ts)
    return F.concat(F.substring(s, 1, 10), F.lit("T"), F.substring(s, 12, 8))


def api_time_text(ts: Column | str) -> Column:
    """NTZ -> 'MM-dd-yyyy HH:mm' (request parameter form)."""
    s = _ntz_text(ts)
    return F.concat(
        F.substring(s, 6, 2), F.lit("-"), F.substring(s, 9, 2), F.lit("-"), F.substring(s, 1, 4),
        F.lit(" "), F.substring(s, 12, 5),
    )


def pull_key(ts: Column | str) -> Column:
    """UTC NTZ -> 'yyyyMMddTHHmm': a pull's key, safe in folder names and
    sorting in time order."""
    s = _ntz_text(ts)
    return F.concat(F.substring(s, 1, 4), F.substring(s, 6, 2), F.substring(s, 9, 2), F.lit("T"),
                    F.substring(s, 12, 2), F.substring(s, 15, 2))


def iso_utc_text(ts: Column | str) -> Column:
    """UTC NTZ -> 'yyyy-MM-ddTHH:mm:ss+0000' (message begin time)."""
    return F.concat(raw_time_text(ts), F.lit("+0000"))


def parse_iso_offset(text: Column | str) -> Column:
    """'yyyy-MM-ddTHH:mm:ss±HHMM' -> UTC NTZ; NULL when malformed."""
    t = _c(text)
    ok = t.rlike(_ISO_OFFSET_PATTERN) & F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd").isNotNull()
    local = F.to_timestamp_ntz(F.substring(t, 1, 19), F.lit(RAW_TIME_FORMAT))
    sign = F.when(F.substring(t, 20, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    offset_min = sign * (F.substring(t, 21, 2).try_cast("int") * 60 + F.substring(t, 23, 2).try_cast("int"))
    return F.when(ok, F.timestamp_add("MINUTE", -offset_min, local))
