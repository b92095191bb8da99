"""Q1: share of congested reports per weekday hour inside a map box.

Plan shape: one scan -> filter -> hash aggregate on the hour (partial aggregate in every map
task, so at most 24 rows per task reach the shuffle whatever the data size or skew) ->
ratio -> sort of at most 24 rows in one partition. The total and congested counts come from the same pass
(``count`` beside ``count_if``) instead of two filtered branches joined back together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import flag_set, hour_in, in_box, is_weekday
from fleetlens.operators._checks import require_columns

# The reference's default area of interest and hours.
DEFAULT_NORTH = 53.3702027
DEFAULT_EAST = -6.2043634
DEFAULT_SOUTH = 53.3343619
DEFAULT_WEST = -6.2886331
DEFAULT_HOURS = ["07", "08", "09"]


def hour_text(hour_number):
    return F.format_string("%02d", hour_number)


def congestion_by_hour(
    m: DataFrame,
    north: float = DEFAULT_NORTH,
    east: float = DEFAULT_EAST,
    south: float = DEFAULT_SOUTH,
    west: float = DEFAULT_WEST,
    hours: Sequence[str] = tuple(DEFAULT_HOURS),
) -> DataFrame:
    """``(hour, percentage, numMeasurements, congestionMeasurements)``.

    Hours with no congested report are absent (the reference joins the congested counts
    to the totals with an inner join, so 0 % never appears). Percentage is
    ``round(C / T * 100, 2)`` half-up; ordered by percentage desc, then hour asc.
    """
    require_columns(m, "ts", "day", "latitude", "longitude", "congestion")
    kept = m.filter(
        is_weekday(F.col("day"))
        & hour_in(F.col("ts"), hours)
        & in_box(F.col("latitude"), F.col("longitude"), north, east, south, west)
    )
    per_hour = kept.groupBy(F.hour("ts").alias("_h")).agg(
        F.count(F.lit(1)).alias("numMeasurements"),
        F.count_if(flag_set(F.col("congestion"))).alias("congestionMeasurements"),
    )
    t = F.col("numMeasurements")
    c = F.col("congestionMeasurements")
    # At most 24 result rows (one per hour of day): a single partition orders them without
    # the sampling job a range-partitioned global sort needs.
    return (
        per_hour.filter(c > 0)
        .select(
            hour_text(F.col("_h")).alias("hour"),
            F.round(c / t * 100, 2).alias("percentage"),
            t,
            c,
        )
        .repartition(1)
        .sortWithinPartitions(F.col("percentage").desc(), F.col("hour").asc())
    )


def reports_per_hour(m: DataFrame) -> DataFrame:
    """``(hour, numMeasurements)`` over all reports."""
    require_columns(m, "ts")
    # group on the integer hour; format the (at most 24) result rows, not every input row
    per_hour = m.groupBy(F.hour("ts").alias("_h")).agg(F.count(F.lit(1)).alias("numMeasurements"))
    return per_hour.select(hour_text(F.col("_h")).alias("hour"), "numMeasurements")


def hourly_counts_joined(m: DataFrame) -> DataFrame:
    """Per-hour totals inner-joined with per-hour congested counts (the two-branch form).

    Both branches are cut from one aggregate keyed by (hour, congested), so the executed
    plan reads the input once (the second branch reuses the first one's exchange). Each side
    has at most 24 rows, one per hour of day: broadcasting one of them is safe at any input
    size, and the join itself needs no shuffle.
    """
    require_columns(m, "ts", "congestion")
    per_flag = (
        m.groupBy(F.hour("ts").alias("_h"), flag_set(F.col("congestion")).alias("_congested"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(hour_text(F.col("_h")).alias("hour"), "_congested", "_n")
    )
    totals = per_flag.groupBy("hour").agg(F.sum("_n").alias("numMeasurements"))
    # Not `filter(_congested)` first: a filter on a grouping key is pushed below the
    # aggregate, which would split the plan into two scans. Hours with no congested report
    # get NULL here and are dropped, as the inner join in the two-branch form drops them.
    congested = (
        per_flag.groupBy("hour")
        .agg(F.sum(F.when(F.col("_congested"), F.col("_n"))).alias("congestionMeasurements"))
        .filter(F.col("congestionMeasurements").isNotNull())
    )
    return totals.join(F.broadcast(congested), "hour").select(
        "hour", "numMeasurements", "congestionMeasurements"
    )
