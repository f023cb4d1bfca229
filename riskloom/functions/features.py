"""Scalar feature expressions (built-in Column functions, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km used by the great-circle distance.
EARTH_RADIUS_KM = 6371.0


def hour(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6 (``weekday``; ``dayofweek`` would give Sunday = 1)."""
    return F.weekday(ts)


def month(ts: Column) -> Column:
    return F.month(ts)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; ``least(a, 1)`` guards ``asin(1 + eps)`` = NaN."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Text -> timestamp; malformed text gives NULL (ANSI ``to_timestamp`` would throw)."""
    return F.try_to_timestamp(text) if fmt is None else F.try_to_timestamp(text, F.lit(fmt))


def epoch_seconds_ntz(ts: Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock (``TIMESTAMP_NTZ``) value, independent of
    the session time zone."""
    return (
        F.unix_date(F.to_date(ts)).cast("long") * F.lit(86400)
        + F.hour(ts) * F.lit(3600)
        + F.minute(ts) * F.lit(60)
        + F.second(ts)
    )
