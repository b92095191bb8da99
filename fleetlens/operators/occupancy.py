"""Q3: in a time window, the stop(s) served by the most distinct vehicles, with the sorted
vehicle list. All stops tied at the maximum are kept.

Plan, built for a stop that may hold a third of all rows:

1. ``distinct(stop, vehicle)`` - partial dedupe in every map task, then a shuffle keyed on
   the *pair*, so a hot stop is spread over as many tasks as it has vehicles.
2. the number of vehicles per stop over these pairs: partial counts, one row per stop and task.
3. the global maximum is a one-row aggregate of step 2, joined back on the count (a one-row
   broadcast: its size is fixed, not estimated); what is left are the winners.
4. the pairs of step 1 meet the winners, and lists are built for those only. A list holds
   distinct vehicles, so its length is bounded by the fleet, not by the number of reports.

The joins are null-safe: plain equality would make the optimizer add not-null filters to one
side, whose exchanges would then differ from the other's. As it is the executed plan reads the
input once and reuses the exchanges of steps 1 and 2. The winners are not hinted for
broadcast, since every stop may tie; adaptive execution decides by their size.

No driver round trip for the maximum and no single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import flag_set, in_window
from fleetlens.operators._checks import require_columns, without_no_stop

# The reference's default window.
DEFAULT_START = "2013-01-07 06:30:00"
DEFAULT_HORIZON_SECONDS = 1800


def _stop_vehicle_pairs(m: DataFrame) -> DataFrame:
    require_columns(m, "closerStopID", "vehicleID")
    return m.select("closerStopID", "vehicleID").distinct()


def _winners(pairs: DataFrame) -> DataFrame:
    """``(_stop)``: the stops with the most vehicles (a NULL vehicle counts nowhere)."""
    counts = pairs.groupBy("closerStopID").agg(F.count("vehicleID").alias("_n"))
    top = counts.agg(F.max("_n").alias("_top"))
    return counts.join(F.broadcast(top), F.col("_n").eqNullSafe(F.col("_top"))).select(
        F.col("closerStopID").alias("_stop")
    )


def busiest_stops(
    m: DataFrame,
    current_time: str = DEFAULT_START,
    seconds_horizon: int = DEFAULT_HORIZON_SECONDS,
    exclude_no_stop: bool = False,
) -> DataFrame:
    """``(stationID, sortedvehicleIDList array<int>)`` ordered by stationID.

    The window ``[current_time, current_time + seconds_horizon]`` is inclusive at both ends.
    An empty window gives an empty result. ``exclude_no_stop`` leaves out reports with no stop
    nearby, which otherwise compete as a stop of their own.
    """
    require_columns(m, "ts", "day", "atStop", "closerStopID", "vehicleID")
    kept = m.filter(
        in_window(F.col("ts"), current_time, seconds_horizon, F.col("day"))
        & flag_set(F.col("atStop"))
    )
    if exclude_no_stop:
        kept = without_no_stop(kept)
    pairs = _stop_vehicle_pairs(kept)
    return (
        pairs.join(_winners(pairs), F.col("closerStopID").eqNullSafe(F.col("_stop")))
        .groupBy("closerStopID")
        .agg(F.sort_array(F.collect_list("vehicleID")).alias("sortedvehicleIDList"))
        .select(F.col("closerStopID").alias("stationID"), "sortedvehicleIDList")
        .orderBy("stationID")
    )


def vehicles_per_stop(m: DataFrame) -> DataFrame:
    """``(closerStopID, vehicleIDs sorted, numVehicles)`` over at-stop reports.

    Lists are built from deduplicated pairs, so each list holds distinct vehicles only.
    """
    pairs = _stop_vehicle_pairs(m.filter(flag_set(F.col("atStop"))))
    return pairs.groupBy("closerStopID").agg(
        F.sort_array(F.collect_list("vehicleID")).alias("vehicleIDs"),
        F.count("vehicleID").cast("int").alias("numVehicles"),
    )


def max_vehicles(m: DataFrame) -> DataFrame:
    """``(max_size)``: the largest number of distinct vehicles seen at one stop."""
    pairs = _stop_vehicle_pairs(m.filter(flag_set(F.col("atStop"))))
    counts = pairs.groupBy("closerStopID").agg(F.count("vehicleID").alias("n"))
    return counts.agg(F.max("n").cast("int").alias("max_size"))
