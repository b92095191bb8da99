"""Row predicates of the five questions.

Time predicates compare the typed ``ts`` column (and the ``day`` partition column) with
folded literals: on parquet they become PushedFilters / PartitionFilters, and no string is
re-parsed per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.timefmt import (
    date_literal,
    ntz_literal,
    parse_day,
    window_bounds,
)


def is_weekday(day: Column) -> Column:
    """Monday to Friday (``dayofweek``: 1 = Sunday ... 7 = Saturday).

    Pass the ``day`` column: on the store it is the partition column, so the predicate is
    evaluated per directory and weekend days are never opened. A timestamp works too.
    """
    return F.dayofweek(day).between(2, 6)


def _hour_numbers(hours: Iterable[str]) -> list[int]:
    # Hours are two-character strings ("07"); anything else can never equal a formatted
    # hour, so it selects nothing ("7" does not match 07:xx), exactly as a string compare.
    wanted = set()
    for h in hours:
        if isinstance(h, str) and len(h) == 2 and h.isascii() and h.isdigit() and int(h) < 24:
            wanted.add(int(h))
    return sorted(wanted)


def hour_in(ts: Column, hours: Iterable[str]) -> Column:
    """``format('%02d', hour(ts)) IN hours``, evaluated as an integer ``IN`` on ``hour(ts)``."""
    numbers = _hour_numbers(hours)
    if not numbers:
        return F.lit(False)
    return F.hour(ts).isin(numbers)


def in_box(
    latitude: Column,
    longitude: Column,
    north: float,
    east: float,
    south: float,
    west: float,
) -> Column:
    """Inside the box, all four edges inclusive."""
    return latitude.between(float(south), float(north)) & longitude.between(
        float(west), float(east)
    )


def on_day(ts: Column, day: str, day_col: Column | None = None) -> Column:
    """Calendar-day equality as a half-open range ``[day, day + 1)`` on ``ts``.

    ``day_col`` (the store's partition column) adds an equality that prunes directories.
    """
    d = parse_day(day)
    start = _dt.datetime(d.year, d.month, d.day)
    cond = (ts >= ntz_literal(start)) & (ts < ntz_literal(start + _dt.timedelta(days=1)))
    if day_col is not None:
        cond = (day_col == date_literal(d)) & cond
    return cond


def in_window(ts: Column, start: str, seconds: int, day_col: Column | None = None) -> Column:
    """``start <= time <= start + seconds`` at second resolution (both ends inclusive).

    Written as ``start <= ts < end + 1s``: for whole-second ``ts`` that is the inclusive
    end; for a sub-second ``ts`` it keeps exactly the reports whose ``date`` text is inside
    (12:30:00.5 prints as 12:30:00). Both sides stay plain comparisons on ``ts``.
    """
    lo, _ = window_bounds(start, seconds)  # validates the parameters
    start_lit = ntz_literal(lo)
    # The end stays an expression (start + INTERVAL n SECONDS); Catalyst folds it to a literal
    # before planning, so it still reaches the scan as a pushed filter.
    end = start_lit + F.make_dt_interval(secs=F.lit(int(seconds)))
    end_excl = start_lit + F.make_dt_interval(secs=F.lit(int(seconds) + 1))
    cond = (ts >= start_lit) & (ts < end_excl)
    if day_col is not None:
        cond = day_col.between(date_literal(lo.date()), F.to_date(end)) & cond
    return cond


def flag_set(flag: Column) -> Column:
    """0/1 integer flag equals 1 (``congestion``, ``atStop``)."""
    return flag == 1


def on_time(delay: Column, limit: int) -> Column:
    """1 when ``-limit <= delay <= limit``, else 0 (an int column, not a boolean)."""
    return F.when(delay.between(-limit, limit), F.lit(1)).otherwise(F.lit(0))
