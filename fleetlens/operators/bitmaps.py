"""Distinct vehicles per stop as exact bitmaps.

A vehicle number is a bit: bucket ``bitmap_bucket_number`` of 32,768 numbers, place
``bitmap_bit_position`` in it, one to one for every number. Every map task folds its reports of a
(stop, bucket) into one bitmap of 4 KB, so what is shuffled follows the stops and the buckets the
fleet's numbers fall in, not the (stop, vehicle) pairs; a hot stop is one row per task and bucket.
That pays where a stop meets hundreds of vehicles (a pair is some 12 bytes); for sparse stops the
pairs of ``operators.occupancy`` are smaller, and mergeable states need the bitmaps either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import flag_set, in_window
from fleetlens.operators._checks import require_columns, without_no_stop
from fleetlens.operators.occupancy import DEFAULT_HORIZON_SECONDS, DEFAULT_START

BITS = 8 * 4096


def vehicle_bitmaps(m: DataFrame, *more: str) -> DataFrame:
    """``(closerStopID, bucket, vehicles)`` of all rows of ``m``; a NULL vehicle sets no bit, but
    its stop has a row."""
    require_columns(m, "closerStopID", "vehicleID")
    vehicle = F.col("vehicleID").cast("long")
    return m.groupBy(*more, "closerStopID", F.bitmap_bucket_number(vehicle).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(vehicle)).alias("vehicles")
    )


def bitmap_counts(bitmaps: DataFrame) -> DataFrame:
    """``(closerStopID, numVehicles)`` of merged bitmaps, one row per (stop, bucket)."""
    n = F.sum(F.bitmap_count("vehicles")).cast("int")
    return bitmaps.groupBy("closerStopID").agg(n.alias("numVehicles"))


def _numbers(bucket: Column, bitmap: Column) -> Column:
    """The numbers whose bits are set, as an array."""
    at = F.sequence(F.lit(0), F.lit(BITS // 8 - 1))
    # only bytes that hold a bit are looked at bit by bit
    octets = F.transform(
        at,
        lambda i: F.struct(
            i.alias("i"), F.conv(F.hex(F.substring(bitmap, i + 1, F.lit(1))), 16, 10).cast("int").alias("v")
        ),
    )
    places = F.flatten(
        F.transform(
            F.filter(octets, lambda x: x["v"] != 0),
            lambda x: F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.lit(7)),
                    lambda b: F.expr("1").bitwiseAND(F.call_function("shiftright", x["v"], b)) == 1,
                ),
                lambda b: x["i"] * 8 + b,
            ),
        )
    )
    # the inverse of bucket and place; numbers above zero start at bucket 1
    return F.transform(
        places,
        lambda p: F.when(bucket > 0, (bucket - 1) * BITS + p + 1).otherwise(bucket * BITS - p).cast("int"),
    )


def vehicle_lists(bitmaps: DataFrame) -> DataFrame:
    """``(closerStopID, vehicleIDs sorted, numVehicles)`` of merged bitmaps."""
    own = bitmaps.select(
        "closerStopID",
        # a bucket is NULL where only NULL vehicles fell in it
        F.coalesce(_numbers(F.col("bucket"), F.col("vehicles")), F.array().cast("array<int>")).alias("_v"),
    )
    lists = own.groupBy("closerStopID").agg(
        F.sort_array(F.flatten(F.collect_list("_v"))).alias("vehicleIDs")
    )
    return lists.select("closerStopID", "vehicleIDs", F.size("vehicleIDs").alias("numVehicles"))


def _at_stop(m: DataFrame) -> DataFrame:
    require_columns(m, "atStop")
    return m.filter(flag_set(F.col("atStop")))


def vehicles_per_stop_bitmap(m: DataFrame) -> DataFrame:
    """``(closerStopID, numVehicles)`` over at-stop reports."""
    return bitmap_counts(vehicle_bitmaps(_at_stop(m)))


def max_vehicles_bitmap(m: DataFrame) -> DataFrame:
    """``(max_size)``: the largest number of distinct vehicles seen at one stop."""
    return vehicles_per_stop_bitmap(m).agg(F.max("numVehicles").alias("max_size"))


def busiest_stops_bitmap(
    m: DataFrame,
    current_time: str = DEFAULT_START,
    seconds_horizon: int = DEFAULT_HORIZON_SECONDS,
    exclude_no_stop: bool = False,
) -> DataFrame:
    """Q3 by bitmaps: ``(stationID, sortedvehicleIDList)``; lists are read off the winners' only.

    As in ``busiest_stops`` the maximum is a one-row aggregate joined back on the count, and the
    bitmaps' exchange serves both sides of the joins.
    """
    require_columns(m, "ts", "day")
    kept = _at_stop(m).filter(in_window(F.col("ts"), current_time, seconds_horizon, F.col("day")))
    if exclude_no_stop:
        kept = without_no_stop(kept)
    bitmaps = vehicle_bitmaps(kept)
    counts = bitmap_counts(bitmaps)
    top = counts.agg(F.max("numVehicles").alias("_top"))
    winners = counts.join(
        F.broadcast(top), F.col("numVehicles").eqNullSafe(F.col("_top"))
    ).select(F.col("closerStopID").alias("_stop"))
    won = bitmaps.join(winners, F.col("closerStopID").eqNullSafe(F.col("_stop")), "left_semi")
    return (
        vehicle_lists(won)
        .select(
            F.col("closerStopID").alias("stationID"),
            F.col("vehicleIDs").alias("sortedvehicleIDList"),
        )
        .orderBy("stationID")
    )
