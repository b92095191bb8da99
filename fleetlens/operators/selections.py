"""Row-level selections the questions are built from, exposed one by one.

Each is a filter plus a projection: it runs in one whole-stage-codegen stage, with the
column references pruned down to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import (
    day_label,
    flag_set,
    hour_in,
    hour_label,
    in_box,
    in_window,
    is_weekday,
    on_day,
    on_time,
    time_of_day,
)
from fleetlens.operators.congestion import (
    DEFAULT_EAST,
    DEFAULT_HOURS,
    DEFAULT_NORTH,
    DEFAULT_SOUTH,
    DEFAULT_WEST,
)
from fleetlens.operators.timetable import DEFAULT_DELAY_LIMIT


def weekday_reports(m: DataFrame) -> DataFrame:
    """``(date, vehicleID)`` of Monday-Friday reports (F1)."""
    return m.filter(is_weekday(F.col("day"))).select("date", "vehicleID")


def hour_in_list(m: DataFrame, hours: Sequence[str] = tuple(DEFAULT_HOURS)) -> DataFrame:
    """``(date, hour)`` of reports whose two-digit hour is in ``hours`` (F2)."""
    return m.filter(hour_in(F.col("ts"), hours)).select(
        "date", hour_label(F.col("ts")).alias("hour")
    )


def congested_reports(m: DataFrame) -> DataFrame:
    """``(date, busLineID, congestion)`` of congested reports (F3)."""
    return m.filter(flag_set(F.col("congestion"))).select("date", "busLineID", "congestion")


def in_box_reports(
    m: DataFrame,
    north: float = DEFAULT_NORTH,
    east: float = DEFAULT_EAST,
    south: float = DEFAULT_SOUTH,
    west: float = DEFAULT_WEST,
) -> DataFrame:
    """``(date, longitude, latitude)`` of reports inside the box, edges included (F4)."""
    return m.filter(
        in_box(F.col("latitude"), F.col("longitude"), north, east, south, west)
    ).select("date", "longitude", "latitude")


def vehicle_day(m: DataFrame, vehicle_id: int, day: str) -> DataFrame:
    """``(date, vehicleID, only_days)`` of one vehicle on one day (F5, F6)."""
    return m.filter(
        (F.col("vehicleID") == int(vehicle_id)) & on_day(F.col("ts"), day, F.col("day"))
    ).select("date", "vehicleID", day_label(F.col("ts")).alias("only_days"))


def time_window(m: DataFrame, current_time: str, seconds_horizon: int) -> DataFrame:
    """``(date, vehicleID)`` inside the inclusive window (F8)."""
    return m.filter(
        in_window(F.col("ts"), current_time, seconds_horizon, F.col("day"))
    ).select("date", "vehicleID")


def at_stop_times(m: DataFrame) -> DataFrame:
    """``(vehicleID, only_hours)`` of at-stop reports (F7)."""
    return m.filter(flag_set(F.col("atStop"))).select(
        "vehicleID", time_of_day(F.col("ts")).alias("only_hours")
    )


def on_time_flag(m: DataFrame, delay_limit: int = DEFAULT_DELAY_LIMIT) -> DataFrame:
    """``(date, delay, onTime)`` for every report (F10)."""
    return m.select("date", "delay", on_time(F.col("delay"), delay_limit).alias("onTime"))
