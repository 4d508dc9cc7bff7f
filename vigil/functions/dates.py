"""Report days and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss z", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "d MMM yyyy HH:mm:ss Z")


def parse_ts(text: Column) -> Column:
    """Timestamp of a text in any of the known forms (UTC where it names no zone); a bare date is null."""
    plain = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in FORMATS])


def slot_start(ts: Column, zone: str = "Asia/Taipei", hour: int = 6) -> Column:
    """Latest local ``hour`` o'clock at or before ``ts``."""
    local = F.from_utc_timestamp(ts, zone) - F.expr(f"INTERVAL {hour} HOURS")
    return F.to_utc_timestamp(F.date_trunc("day", local) + F.expr(f"INTERVAL {hour} HOURS"), zone)


def slot_date(ts: Column, zone: str = "Asia/Taipei", hour: int = 6) -> Column:
    """Local date of the slot that holds ``ts``."""
    return F.to_date(F.from_utc_timestamp(ts, zone) - F.expr(f"INTERVAL {hour} HOURS"))


def in_window(ts: Column, since: Column, until: Column) -> Column:
    return (ts >= since) & (ts < until)


def days_since(day: Column, end: Column) -> Column:
    return F.datediff(end, day)
