"""Clock and calendar column expressions.

All builders return Columns; nothing here triggers a job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_TZ = "America/Chicago"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_ending_to_ts(date, hour_ending) -> Column:
    """``"01:00".."24:00"`` (spaces allowed) on a delivery date -> hour-ending
    timestamp; ``"24:00"`` rolls over to 00:00 of the next day."""
    h = F.trim(F.replace(_c(hour_ending).cast("string"), F.lit(":00"), F.lit(""))).try_cast("int")
    return F.to_timestamp_ntz(_c(date).cast("string")) + F.make_dt_interval(hours=h)


def interval_to_ts(date, hour, interval) -> Column:
    """Delivery date + hour (1-24) + 15-minute interval (1-4) -> interval start."""
    minutes = (_c(hour) - 1) * 60 + (_c(interval) - 1) * 15
    return F.to_timestamp_ntz(_c(date).cast("string")) + F.make_dt_interval(mins=minutes)


def shift_hours(ts, hours: int) -> Column:
    """Hour-ending <-> hour-beginning alignment (``ts +/- INTERVAL n HOUR``)."""
    return _c(ts) + F.make_dt_interval(hours=F.lit(hours))


def utc_to_market_local(ts, tz: str = MARKET_TZ) -> Column:
    """UTC wall clock -> market-local wall clock (timestamp_ntz)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def strip_tz_keep_wall(s) -> Column:
    """``'2025-12-05 00:00:00.250-06:00'`` -> wall clock; the offset alone is dropped."""
    return F.to_timestamp_ntz(F.regexp_replace(_c(s), r"(:\d{2}(?:\.\d+)?)\s*(?:Z|[+-]\d{2}(?::?\d{2})?)$", "$1"))


def trunc_ntz(ts, unit: str) -> Column:
    """Truncate a wall-clock timestamp to ``minute`` / ``hour`` / ``day`` /
    ``week`` (Monday) without passing through the session time zone
    (``date_trunc`` on timestamp_ntz round-trips through it)."""
    c = _c(ts)
    if unit == "week":
        return F.to_timestamp_ntz(F.date_sub(F.to_date(c), F.weekday(c)))
    if unit == "day":
        return F.to_timestamp_ntz(F.to_date(c))
    parts = {"hour": (F.hour(c), F.lit(0)), "minute": (F.hour(c), F.minute(c))}[unit]
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), parts[0], parts[1], F.lit(0))


def floor_hour(ts) -> Column:
    return trunc_ntz(ts, "hour")


def calendar_columns(ts) -> dict[str, Column]:
    """hour, day_of_week (Mon=0), month, is_weekend, date, year."""
    t = _c(ts)
    dow = F.weekday(t)
    return {
        "hour": F.hour(t),
        "day_of_week": dow,
        "month": F.month(t),
        "is_weekend": dow.isin(5, 6).cast("int"),
        "date": F.to_date(t),
        "year": F.year(t),
    }


def cyclic_hour(hour) -> dict[str, Column]:
    a = F.lit(2 * math.pi) * _c(hour) / F.lit(24.0)
    return {"hour_sin": F.sin(a), "hour_cos": F.cos(a)}


def era_flag(ts, cutoff: str) -> Column:
    """1 before ``cutoff`` (market redesign), else 0."""
    return (_c(ts) < F.to_timestamp_ntz(F.lit(cutoff))).cast("int")


def days_since(ts, start: str) -> Column:
    """Whole days elapsed since ``start`` (floor of the time difference)."""
    return F.datediff(F.to_date(_c(ts)), F.to_date(F.lit(start)))


def in_season(month, months=(6, 7, 8, 9)) -> Column:
    return _c(month).isin(*months).cast("int")


def in_hour_window(hour, lo: int = 14, hi: int = 19) -> Column:
    """Inclusive hour window (14-19 is six hours)."""
    return _c(hour).between(lo, hi).cast("int")
