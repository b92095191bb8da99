"""The questions over all history, from partial states that can be added up.

A state holds what an aggregate needs of some rows, in a form of which any number can be merged:

* ``line_delays`` (Q5, A7, A8): per line the number of at-stop reports, the sum of their delays and
  of their absolute values. A line with one report in all keeps its sign, which no average of
  averages could tell, but the three sums do.
* ``hours`` (Q1 without a box, A1, A2): reports and congested reports per day and hour.
* ``stop_vehicles`` (A5, A9, T1): per stop and bucket of 32,768 vehicle numbers an exact bitmap. A
  union of bitmaps counts a vehicle once, however many states it is in.

``make`` turns reports into a state, ``merge`` states into one; both are an aggregate with a partial
stage (by hash; by sort for bitmaps, whose buffer is no fixed-width value). ``sources.states`` keeps the states of a store's batches.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import flag_set, is_weekday
from fleetlens.operators._checks import require_columns
from fleetlens.operators.bitmaps import bitmap_counts, vehicle_bitmaps, vehicle_lists
from fleetlens.operators.congestion import hour_text


class State(NamedTuple):
    keys: list[str]
    make: Callable[..., DataFrame]  # (reports, *more keys)
    merge: dict[str, Callable]  # aggregate by column
    schema: str


def _make_line_delays(m: DataFrame, *more: str) -> DataFrame:
    require_columns(m, "atStop", "busLineID", "delay")
    delay = F.col("delay").cast("long")  # widen first: abs(INT_MIN) overflows an int
    return (
        m.filter(flag_set(F.col("atStop")))
        .groupBy(*more, "busLineID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(delay).alias("sum_delay"),
            F.sum(F.abs(delay)).alias("sum_abs_delay"),
        )
    )


def _make_hours(m: DataFrame, *more: str) -> DataFrame:
    require_columns(m, "ts", "day", "congestion")
    return m.groupBy(*more, "day", F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("reports"),
        F.count_if(flag_set(F.col("congestion"))).alias("congested"),
    )


def _make_stop_vehicles(m: DataFrame, *more: str) -> DataFrame:
    require_columns(m, "atStop", "closerStopID", "vehicleID")
    return vehicle_bitmaps(m.filter(flag_set(F.col("atStop"))), *more)


STATES = {
    "line_delays": State(
        ["busLineID"],
        _make_line_delays,
        {"n": F.sum, "sum_delay": F.sum, "sum_abs_delay": F.sum},
        "busLineID int, n long, sum_delay long, sum_abs_delay long",
    ),
    "hours": State(
        ["day", "hour"],
        _make_hours,
        {"reports": F.sum, "congested": F.sum},
        "day date, hour int, reports long, congested long",
    ),
    "stop_vehicles": State(
        ["closerStopID", "bucket"],
        _make_stop_vehicles,
        {"vehicles": F.bitmap_or_agg},
        "closerStopID int, bucket long, vehicles binary",
    ),
}


def make(kind: str, m: DataFrame, *more: str) -> DataFrame:
    """The state of reports ``m``, apart for every value of the columns ``more``."""
    return STATES[kind].make(m, *more)


def merge(kind: str, states: DataFrame) -> DataFrame:
    """One state out of many: as if it had been made from all their reports at once."""
    state = STATES[kind]
    return states.groupBy(*state.keys).agg(*[f(c).alias(c) for c, f in state.merge.items()])


def history_line_delay_average(states: DataFrame) -> DataFrame:
    """Q5 from ``line_delays`` states: ``(lineID, average)``; one report in all keeps its sign."""
    total = F.when(F.col("n") == 1, F.col("sum_delay")).otherwise(F.col("sum_abs_delay"))
    return (
        merge("line_delays", states)
        .select(
            F.col("busLineID").alias("lineID"),
            (total.cast("double") / F.col("n")).alias("average"),
        )
        .orderBy("average", "lineID")
    )


def history_line_abs_delay_average(states: DataFrame) -> DataFrame:
    """The mean of ``|delay|`` per line, from ``line_delays`` states."""
    return (
        merge("line_delays", states)
        .select(
            F.col("busLineID").alias("lineID"),
            (F.col("sum_abs_delay").cast("double") / F.col("n")).alias("average"),
        )
        .orderBy("average", "lineID")
    )


def history_hourly_counts(states: DataFrame, weekdays_only: bool = False) -> DataFrame:
    """``(hour, numMeasurements, congestionMeasurements)`` from ``hours`` states, hours with a
    congested report only; with ``weekdays_only`` Q1's counts over the whole map."""
    if weekdays_only:
        states = states.filter(is_weekday(F.col("day")))
    per_hour = states.groupBy("hour").agg(
        F.sum("reports").alias("numMeasurements"), F.sum("congested").alias("congestionMeasurements")
    )
    return per_hour.filter(F.col("congestionMeasurements") > 0).select(
        hour_text(F.col("hour")).alias("hour"), "numMeasurements", "congestionMeasurements"
    )


def history_vehicles_per_stop(states: DataFrame) -> DataFrame:
    """``(closerStopID, numVehicles)`` from ``stop_vehicles`` states."""
    return bitmap_counts(merge("stop_vehicles", states))


def history_vehicle_lists(states: DataFrame) -> DataFrame:
    """``(closerStopID, vehicleIDs sorted, numVehicles)`` from ``stop_vehicles`` states."""
    return vehicle_lists(merge("stop_vehicles", states))
