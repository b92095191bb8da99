"""The one fact table: a position report of one bus.

The ten source fields keep their order and names. Two derived columns are added by every
source so that operators never re-parse text:

* ``ts``  - the instant as ``timestamp_ntz`` (no time zone involved). From text it has
  second resolution; a source may keep finer precision, and every predicate is written to
  give the same answer either way (``date`` is always the second-resolution text).
* ``day`` - ``ts`` as a ``date``; the partition column of the parquet store, so day and window
  filters prune whole directories there.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field order and names of the input rows.
MEASUREMENT_COLUMNS = [
    "date",
    "busLineID",
    "busLinePatternID",
    "congestion",
    "longitude",
    "latitude",
    "delay",
    "vehicleID",
    "closerStopID",
    "atStop",
]

# Sentinel used by the input for "no stop nearby"; it is an ordinary group value.
NO_STOP = -1

MEASUREMENTS_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType(), True),
        T.StructField("busLineID", T.IntegerType(), True),
        T.StructField("busLinePatternID", T.StringType(), True),
        T.StructField("congestion", T.IntegerType(), True),
        # 64-bit on purpose: 32-bit floats move points on the box edge out of the box.
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("delay", T.IntegerType(), True),
        T.StructField("vehicleID", T.IntegerType(), True),
        T.StructField("closerStopID", T.IntegerType(), True),
        T.StructField("atStop", T.IntegerType(), True),
    ]
)

DERIVED_COLUMNS = ["ts", "day"]

TYPED_SCHEMA = T.StructType(
    MEASUREMENTS_SCHEMA.fields
    + [
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("day", T.DateType(), True),
    ]
)
