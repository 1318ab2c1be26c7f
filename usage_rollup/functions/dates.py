"""Bound arithmetic on the driver: which date partitions a timestamp range touches.

Date partitions are ``to_date(ts)`` in the session zone (UTC, see session.py).
A bound without an offset is already session-local; a bound with an offset is
converted to the session zone first, as Spark's string-to-timestamp cast does.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo


def session_zone(spark) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")


def local_instant(v, zone: str = "UTC") -> _dt.datetime:
    """A bound as a naive datetime in ``zone``."""
    t = _dt.datetime.fromisoformat(str(v).strip().replace("Z", "+00:00"))
    if t.tzinfo is not None:
        t = t.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    return t


def range_dates(start, end, zone: str = "UTC") -> list[str]:
    """Dates (``yyyy-MM-dd``) of the partitions ``[start, end)`` touches."""
    s_t, e_t = local_instant(start, zone), local_instant(end, zone)
    last = e_t.date() - _dt.timedelta(days=1) if e_t.time() == _dt.time(0) else e_t.date()
    out, d = [], s_t.date()
    while d <= last:
        out.append(d.isoformat())
        d += _dt.timedelta(days=1)
    return out


def partition_bounds(start, end, zone: str = "UTC") -> tuple[str, str]:
    """First and last partition date of ``[start, end)`` (inclusive; may be empty if last < first)."""
    s_t, e_t = local_instant(start, zone), local_instant(end, zone)
    last = e_t.date() - _dt.timedelta(days=1) if e_t.time() == _dt.time(0) else e_t.date()
    return s_t.date().isoformat(), last.isoformat()
