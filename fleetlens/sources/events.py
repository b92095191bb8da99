"""The driver's ``events`` table seen as bus position reports.

A deterministic projection (documented in FIXTURES.md section 1) that the DuckDB oracle
repeats in SQL, so every operator can be checked on whole driver tables.

``ts`` is passed through untouched (microseconds): a time predicate on it is a plain column
comparison, which parquet receives as a pushed filter and uses to skip row groups.
``date`` is its second-resolution text. The predicates in ``fleetlens.functions`` are exact
for sub-second ``ts`` (see ``in_window``), so no per-row truncation is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetlens.schema import TYPED_SCHEMA

# Fixed values of the projection (they must equal the oracle SQL's).
LON_ORIGIN = -6.30
LAT_ORIGIN = 53.32
LAT_USER_MODULUS = 15
LINE_MODULUS = 7
VEHICLE_BASE = 33000
VEHICLE_MODULUS = 8
STOP_MODULUS = 12
STOP_BASE = 200
DELAY_OFFSET = 20
CONGESTED_EVENT = "error"
NOT_AT_STOP_EVENTS = ["error", "purchase"]


# Fixed value: the columns of ``events`` this projection reads (event_id is not needed).
# Declaring them skips parquet schema inference, which costs a Spark job per read, and
# prunes the scan to these columns from the start.
EVENTS_READ_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


# Key expressions by projection. ``narrow`` folds the keys to a small fixed fleet (8 vehicles,
# 12 stops, 7 lines at any scale); in ``wide`` vehicles, stops and lines grow with the table's
# users, about 1,500 times sf each.
KEYS = {
    "narrow": {
        "busLineID": f"CAST(k % {LINE_MODULUS} AS INT)",
        "vehicleID": f"CAST({VEHICLE_BASE} + user_id % {VEHICLE_MODULUS} AS INT)",
        "closerStopID": f"CAST(CASE WHEN k % {STOP_MODULUS} = 0 THEN -1"
        f" ELSE {STOP_BASE} + k % {STOP_MODULUS} END AS INT)",
    },
    "wide": {
        "busLineID": "CAST(floor(user_id / 4) * 3 + k % 3 AS INT)",
        "vehicleID": f"CAST({VEHICLE_BASE} + user_id AS INT)",
        "closerStopID": f"CAST(CASE WHEN k % {STOP_MODULUS} = 0 THEN -1"
        f" ELSE {STOP_BASE} + floor(user_id / 5) * 4 + k * k % 23 END AS INT)",
    },
}


def measurements_from_events(
    spark: SparkSession, sf_dir: str, keys: str = "narrow"
) -> DataFrame:
    """``events`` as reports; ``keys`` names one of ``KEYS``."""
    own = KEYS[keys]
    ev = spark.read.schema(EVENTS_READ_SCHEMA).parquet(events_path(sf_dir))
    # Written as SQL expressions (two JVM calls instead of about two hundred for the same
    # expressions built call by call); `k` is computed once and read three times.
    keyed = ev.selectExpr(
        "ts",
        "user_id",
        "event_type",
        "value",
        "try_cast(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    )
    not_at_stop = ", ".join(f"'{e}'" for e in NOT_AT_STOP_EVENTS)
    m = keyed.selectExpr(
        "substring(CAST(ts AS STRING), 1, 19) AS date",
        f"{own['busLineID']} AS busLineID",
        "event_type AS busLinePatternID",
        f"CASE WHEN event_type = '{CONGESTED_EVENT}' THEN 1 ELSE 0 END AS congestion",
        f"CAST({LON_ORIGIN!r} AS DOUBLE) + CAST(k AS DOUBLE) / 1000.0D AS longitude",
        f"CAST({LAT_ORIGIN!r} AS DOUBLE)"
        f" + CAST((user_id % {LAT_USER_MODULUS}) * 4 AS DOUBLE) / 1000.0D AS latitude",
        f"CAST(floor(value) AS INT) - {DELAY_OFFSET} AS delay",
        f"{own['vehicleID']} AS vehicleID",
        f"{own['closerStopID']} AS closerStopID",
        f"CASE WHEN event_type IN ({not_at_stop}) THEN 0 ELSE 1 END AS atStop",
        "ts",
        "CAST(ts AS DATE) AS day",
    )
    assert m.columns == TYPED_SCHEMA.fieldNames()
    return m
