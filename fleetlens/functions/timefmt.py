"""Time parsing and formatting on ``timestamp_ntz`` columns (no session time zone involved).

Parameters (a day, a window start) are validated on the driver and enter the plan as typed
literals, so Catalyst folds them and the comparisons reach the scan as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_PY_INSTANT = "%Y-%m-%d %H:%M:%S"
_PY_DAY = "%Y-%m-%d"


def parse_instant(text: str | _dt.datetime) -> _dt.datetime:
    """Validate a ``yyyy-MM-dd HH:mm:ss`` parameter (raises ValueError on a bad one).

    A ``datetime`` is taken as wall-clock time (any tzinfo and sub-second part ignored).
    """
    if isinstance(text, _dt.datetime):
        return text.replace(tzinfo=None, microsecond=0)
    return _dt.datetime.strptime(text, _PY_INSTANT)


def parse_day(text: str | _dt.date) -> _dt.date:
    """Validate a ``yyyy-MM-dd`` parameter; a ``date`` is taken as it is."""
    if isinstance(text, _dt.datetime):
        return text.date()
    if isinstance(text, _dt.date):
        return text
    return _dt.datetime.strptime(text, _PY_DAY).date()


def ntz_literal(value: _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal; never goes through the driver's or session's time zone."""
    return F.expr(f"TIMESTAMP_NTZ '{value.strftime(_PY_INSTANT)}'")


def date_literal(value: _dt.date) -> Column:
    return F.expr(f"DATE '{value.isoformat()}'")


def window_bounds(start: str | _dt.datetime, seconds: int) -> tuple[_dt.datetime, _dt.datetime]:
    """``[start, start + seconds]`` as wall-clock instants (no time zone: no DST jumps)."""
    lo = parse_instant(start)
    return lo, lo + _dt.timedelta(seconds=int(seconds))


def strict_instant(text: Column) -> Column:
    """``timestamp_ntz`` of a ``yyyy-MM-dd HH:mm:ss`` text, NULL for any other form.

    The cast alone also accepts ``2013-1-7`` or a bare date. A whole-second ``timestamp_ntz``
    casts back to exactly that form (no time zone involved), so the round trip is the check.
    """
    ts = text.cast("string").try_cast("timestamp_ntz")
    return F.when(ts.cast("string") == text, ts)


def instant_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a ``timestamp_ntz`` (fraction dropped, not rounded).

    Rendered by casting to string, which for ``timestamp_ntz`` involves no time zone.
    ``date_format`` would first convert to a zoned timestamp in the session zone and shift
    wall-clock times that fall in a daylight-saving gap (02:30 -> 03:30).
    """
    return F.substring(ts.cast("string"), 1, 19)


def hour_label(ts: Column) -> Column:
    """Two-digit hour, e.g. ``"07"``."""
    return F.substring(ts.cast("string"), 12, 2)


def time_of_day(ts: Column) -> Column:
    """``HH:mm:ss`` part of the timestamp."""
    return F.substring(ts.cast("string"), 12, 8)


def day_label(ts: Column) -> Column:
    """``yyyy-MM-dd`` part of the timestamp."""
    return F.substring(ts.cast("string"), 1, 10)
