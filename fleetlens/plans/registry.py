"""Named queries over the driver tables, each paired with equivalent DuckDB SQL.

Every query reads the whole ``events`` table through ``measurements_from_events`` (no id
subsets, no row caps); its work grows with the table. The SQL repeats the same projection
as a CTE, so Spark and DuckDB answer the same question on the same rows. Result order is
not compared (the oracle hash is order-insensitive); ordering is tested separately.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens import operators as ops
from fleetlens.schema import MEASUREMENT_COLUMNS
from fleetlens.session import remove_at_exit, shared_dir
from fleetlens.sources import (
    ingest_csv_to_store,
    ingest_new_files,
    measurements_from_events,
    parse_lines,
    read_ingested,
    read_measurements,
    read_measurements_csv,
    read_measurements_csv_reader,
    read_states,
    refresh_states,
    replay_bad,
    write_measurements,
)
from fleetlens.sources.csv_ingest import PARSER_VERSION
from fleetlens.sources.store import BOX_KEY

# Parameters used on the driver tables (events span 2024-01-01..2024-01-30).
Q1_BOX = dict(north=53.3702027, east=-6.2043634, south=53.3343619, west=-6.2886331)
Q1_HOURS = ["07", "08", "09"]
Q2_VEHICLE = 33001
Q2_DAY = "2024-01-08"
Q2_DELAY_LIMIT = 60
Q3_START = "2024-01-08 06:30:00"
Q3_HORIZON = 21600
# Wider settings of the same operators: every hour of the day; the whole month.
ALL_HOURS = [f"{h:02d}" for h in range(24)]
MONTH_START = "2024-01-01 00:00:00"
MONTH_SECONDS = 31 * 86400
# Landing batches of the stores with a history: the first days of each.
BATCH_STARTS = ["2024-01-01", "2024-01-11", "2024-01-21"]

QueryFn = Callable[[SparkSession, str], DataFrame]


def _m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements_from_events(spark, sf_dir)


def _w(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projection whose vehicles, stops and lines grow with the table."""
    return measurements_from_events(spark, sf_dir, keys="wide")


# Derived copies that several queries read: written once per session and input, and removed
# when the Python process ends.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(
    spark: SparkSession, sf_dir: str, what: str, write: Callable[[str], None]
) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _WRITTEN:
        path = shared_dir(spark, what)
        write(path)
        remove_at_exit(spark, path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _write_text(m: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (
        m.select(*MEASUREMENT_COLUMNS)
        .write.mode(mode)
        .option("header", "false")
        .option("quote", "")
        .option("escape", "")
        .option("nullValue", "")
        .csv(path)
    )


def csv_text(spark: SparkSession, sf_dir: str) -> str:
    """The reports as headerless, unquoted CSV text in the shared folder."""
    return _once(
        spark, sf_dir, "csv-roundtrip", lambda path: _write_text(_m(spark, sf_dir), path)
    )


def ingest_store(spark: SparkSession, sf_dir: str) -> str:
    """An ingest store of that text."""
    text = csv_text(spark, sf_dir)
    return _once(
        spark,
        sf_dir,
        "ingest-store",
        lambda path: ingest_csv_to_store(spark, text, path, batch="events"),
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good reports of the ingest store: text, parse, write, read."""
    return read_ingested(spark, ingest_store(spark, sf_dir)).good


def scan_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV round trip through the strict ingest (split + try_cast, bad rows aside)."""
    path = csv_text(spark, sf_dir)
    return read_measurements_csv(spark, path).good.select(*MEASUREMENT_COLUMNS)


def scan_measurements_csv_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV round trip through the CSV reader with the explicit schema."""
    path = csv_text(spark, sf_dir)
    return read_measurements_csv_reader(spark, path).select(*MEASUREMENT_COLUMNS)


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those reports compacted into a measurements store clustered by vehicle."""

    def write(path: str) -> None:
        write_measurements(_stored(spark, sf_dir), path, cluster=True)

    return read_measurements(spark, _once(spark, sf_dir, "compacted", write))


def _batch(k: int) -> str:
    """Condition on the day of landing batch ``k``."""
    end = "" if k + 1 == len(BATCH_STARTS) else f" AND day < DATE'{BATCH_STARTS[k + 1]}'"
    return f"day >= DATE'{BATCH_STARTS[k]}'{end}"


def history_store(spark: SparkSession, sf_dir: str) -> str:
    """A store of three landing batches with partial states; the second batch first landed with
    wrong rows (delays of another sign, half of the rows twice) and was replaced afterwards."""

    def write(path: str) -> None:
        m = _w(spark, sf_dir)
        text = f"{path}-text"
        remove_at_exit(spark, text)
        for k in range(len(BATCH_STARTS)):
            _write_text(m.filter(_batch(k)), f"{text}/{k}")
        wrong = m.filter(_batch(1)).withColumn("delay", -F.col("delay"))
        _write_text(wrong.unionByName(wrong.filter("minute(ts) < 30")), f"{text}/wrong")
        for k, folder in enumerate(("0", "wrong", "2")):
            ingest_csv_to_store(spark, f"{text}/{folder}", path, batch=f"landing-{k}")
        refresh_states(spark, path)
        ingest_csv_to_store(spark, f"{text}/1", path, batch="landing-1")
        # of the new version the lines' state only: what the others lack is computed as it is read
        refresh_states(spark, path, ["line_delays"])

    return _once(spark, sf_dir, "history-store", write)


def _states(kind: str) -> QueryFn:
    return lambda s, d: read_states(s, history_store(s, d), kind)


def _slashed(lines: DataFrame) -> DataFrame:
    """A parser that also reads ``2024/01/21`` as a day, by the rule before the strict one."""
    mended = F.regexp_replace("value", r"^(\d{4})/(\d\d)/(\d\d) ", "$1-$2-$3 ")
    return parse_lines(lines.select(mended.alias("value")))


def replayed_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose last third has days in another form, which all went to the bad lines; parsed
    again by a parser that knows it."""

    def write(path: str) -> None:
        text = f"{path}-text"
        remove_at_exit(spark, text)
        m = _m(spark, sf_dir)
        late = F.col("day") >= F.lit(BATCH_STARTS[2]).cast("date")
        form = F.when(late, F.translate("date", "-", "/")).otherwise(F.col("date"))
        _write_text(m.withColumn("date", form), text)
        ingest_csv_to_store(spark, text, path, batch="events")
        if replay_bad(spark, path, _slashed, PARSER_VERSION + 1) != ["events"]:
            raise AssertionError("nothing was replayed")

    path = _once(spark, sf_dir, "replayed-store", write)
    good, bad = read_ingested(spark, path)
    return good.select(*MEASUREMENT_COLUMNS).unionByName(  # no bad line is left
        bad.select(*[F.lit(None).alias(c) for c in MEASUREMENT_COLUMNS])
    )


def landed_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder that grows: each run takes the files that have come since."""

    def write(path: str) -> None:
        text = f"{path}-text"
        remove_at_exit(spark, text)
        m = _m(spark, sf_dir)
        for k in range(len(BATCH_STARTS)):
            _write_text(m.filter(_batch(k)), text, mode="append")
            ingest_new_files(spark, text, path, batch=f"landing-{k}")

    return read_ingested(spark, _once(spark, sf_dir, "landed-store", write)).good.select(
        *MEASUREMENT_COLUMNS
    )


def _boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of Q1's box from a store clustered by map cell."""

    def write(path: str) -> None:
        write_measurements(_m(spark, sf_dir), path, cluster=BOX_KEY)

    box = (Q1_BOX["north"], Q1_BOX["east"], Q1_BOX["south"], Q1_BOX["west"])
    return read_measurements(spark, _once(spark, sf_dir, "box-clustered", write), box=box)


def with_position(df: DataFrame) -> DataFrame:
    """The result's rows with their places in it, from the order it comes in (not from its values),
    so that the order enters the comparison. For results of a few rows: they meet in one task."""
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("_at"))
    return numbered.withColumn("position", place).drop("_at")


QUERIES: dict[str, QueryFn] = {
    "congestion_by_hour": lambda s, d: ops.congestion_by_hour(_m(s, d), hours=Q1_HOURS, **Q1_BOX),
    "congestion_by_hour_all_hours": lambda s, d: ops.congestion_by_hour(
        _m(s, d), hours=ALL_HOURS, **Q1_BOX
    ),
    "congestion_by_hour_joined": lambda s, d: ops.hourly_counts_joined(_m(s, d)),
    "first_arrivals": lambda s, d: ops.first_arrivals(
        _m(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT
    ),
    "first_arrivals_by_delay": lambda s, d: ops.first_arrivals_by_delay(
        _m(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT
    ),
    "busiest_stops": lambda s, d: ops.busiest_stops(_m(s, d), Q3_START, Q3_HORIZON),
    "busiest_stops_month": lambda s, d: ops.busiest_stops(_m(s, d), MONTH_START, MONTH_SECONDS),
    "line_delay_average": lambda s, d: ops.line_delay_average(_m(s, d)),
    "line_abs_delay_average": lambda s, d: ops.line_abs_delay_average(_m(s, d)),
    "scan_measurements": scan_measurements,
    "scan_measurements_csv_reader": scan_measurements_csv_reader,
    "weekday_reports": lambda s, d: ops.weekday_reports(_m(s, d)),
    "hour_in_list": lambda s, d: ops.hour_in_list(_m(s, d), Q1_HOURS),
    "congested_reports": lambda s, d: ops.congested_reports(_m(s, d)),
    "in_box": lambda s, d: ops.in_box_reports(_m(s, d), **Q1_BOX),
    "vehicle_day": lambda s, d: ops.vehicle_day(_m(s, d), Q2_VEHICLE, Q2_DAY),
    "time_window": lambda s, d: ops.time_window(_m(s, d), Q3_START, Q3_HORIZON),
    "at_stop_times": lambda s, d: ops.at_stop_times(_m(s, d)),
    "on_time_flag": lambda s, d: ops.on_time_flag(_m(s, d), Q2_DELAY_LIMIT),
    "reports_per_hour": lambda s, d: ops.reports_per_hour(_m(s, d)),
    "vehicles_per_stop": lambda s, d: ops.vehicles_per_stop(_m(s, d)),
    "max_vehicles": lambda s, d: ops.max_vehicles(_m(s, d)),
    "line_delay_sum_count": lambda s, d: ops.line_delay_sum_count(_m(s, d)),
    # keys that grow with the table
    "first_arrivals_wide": lambda s, d: ops.first_arrivals(
        _w(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT
    ),
    "first_arrivals_by_delay_wide": lambda s, d: ops.first_arrivals_by_delay(
        _w(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT, exclude_no_stop=True
    ),
    "busiest_stops_wide": lambda s, d: ops.busiest_stops(_w(s, d), Q3_START, Q3_HORIZON),
    "busiest_stops_wide_month": lambda s, d: ops.busiest_stops(
        _w(s, d), MONTH_START, MONTH_SECONDS
    ),
    "busiest_stops_wide_real": lambda s, d: ops.busiest_stops(
        _w(s, d), MONTH_START, MONTH_SECONDS, exclude_no_stop=True
    ),
    "vehicles_per_stop_wide": lambda s, d: ops.vehicles_per_stop(_w(s, d)),
    "max_vehicles_wide": lambda s, d: ops.max_vehicles(_w(s, d)),
    "line_delay_average_wide": lambda s, d: ops.line_delay_average(_w(s, d)),
    "line_abs_delay_average_wide": lambda s, d: ops.line_abs_delay_average(_w(s, d)),
    "line_delay_sum_count_wide": lambda s, d: ops.line_delay_sum_count(_w(s, d)),
    "congestion_by_hour_joined_wide": lambda s, d: ops.hourly_counts_joined(_w(s, d)),
    # the path at scale: text -> ingest store (-> compacted store) -> question
    "store_measurements": lambda s, d: _stored(s, d).select(*MEASUREMENT_COLUMNS),
    "store_congestion_by_hour": lambda s, d: ops.congestion_by_hour(
        _stored(s, d), hours=Q1_HOURS, **Q1_BOX
    ),
    "store_first_arrivals": lambda s, d: ops.first_arrivals(
        _stored(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT
    ),
    "store_busiest_stops": lambda s, d: ops.busiest_stops(_stored(s, d), Q3_START, Q3_HORIZON),
    "store_line_delay_average": lambda s, d: ops.line_delay_average(_stored(s, d)),
    "compacted_first_arrivals": lambda s, d: ops.first_arrivals(
        _compacted(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT
    ),
    "compacted_busiest_stops": lambda s, d: ops.busiest_stops(
        _compacted(s, d), Q3_START, Q3_HORIZON
    ),
    # the order of the answers, by their places
    "ordered_congestion_by_hour": lambda s, d: with_position(
        ops.congestion_by_hour(_m(s, d), hours=ALL_HOURS, **Q1_BOX)
    ),
    "ordered_first_arrivals": lambda s, d: with_position(
        ops.first_arrivals(_m(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT)
    ),
    "ordered_first_arrivals_by_delay": lambda s, d: with_position(
        ops.first_arrivals_by_delay(_m(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT)
    ),
    "ordered_busiest_stops_month": lambda s, d: with_position(
        ops.busiest_stops(_m(s, d), MONTH_START, MONTH_SECONDS)
    ),
    "ordered_line_delay_average_wide": lambda s, d: with_position(ops.line_delay_average(_w(s, d))),
    "ordered_line_abs_delay_average_wide": lambda s, d: with_position(
        ops.line_abs_delay_average(_w(s, d))
    ),
    # reports near no stop left out
    "first_arrivals_real": lambda s, d: ops.first_arrivals(
        _m(s, d), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT, exclude_no_stop=True
    ),
    # distinct vehicles as bitmaps
    "vehicles_per_stop_bitmap": lambda s, d: ops.vehicles_per_stop_bitmap(_m(s, d)),
    "vehicles_per_stop_bitmap_wide": lambda s, d: ops.vehicles_per_stop_bitmap(_w(s, d)),
    "max_vehicles_bitmap_wide": lambda s, d: ops.max_vehicles_bitmap(_w(s, d)),
    "busiest_stops_bitmap": lambda s, d: ops.busiest_stops_bitmap(_m(s, d), Q3_START, Q3_HORIZON),
    "busiest_stops_bitmap_wide_month": lambda s, d: ops.busiest_stops_bitmap(
        _w(s, d), MONTH_START, MONTH_SECONDS
    ),
    # all history from partial states of a store's batches, one of which was replaced
    "history_line_delay_average": lambda s, d: ops.history_line_delay_average(
        _states("line_delays")(s, d)
    ),
    "history_line_abs_delay_average": lambda s, d: ops.history_line_abs_delay_average(
        _states("line_delays")(s, d)
    ),
    "history_hourly_counts": lambda s, d: ops.history_hourly_counts(_states("hours")(s, d)),
    "history_weekday_counts": lambda s, d: ops.history_hourly_counts(
        _states("hours")(s, d), weekdays_only=True
    ),
    "history_vehicles_per_stop": lambda s, d: ops.history_vehicles_per_stop(
        _states("stop_vehicles")(s, d)
    ),
    "history_vehicle_lists": lambda s, d: ops.history_vehicle_lists(_states("stop_vehicles")(s, d)),
    "replaced_measurements": lambda s, d: read_ingested(s, history_store(s, d)).good.select(
        *MEASUREMENT_COLUMNS
    ),
    # bad lines parsed again; a landing folder that grows; a box on a store clustered by map cell
    "replayed_measurements": replayed_measurements,
    "landed_measurements": landed_measurements,
    "box_store_reports": lambda s, d: ops.in_box_reports(_boxed(s, d), **Q1_BOX),
    "box_store_congestion_by_hour": lambda s, d: ops.congestion_by_hour(
        _boxed(s, d), hours=Q1_HOURS, **Q1_BOX
    ),
}

# The events -> measurements projection in DuckDB (same expressions as the Spark source).
MEASUREMENTS_CTE = """
WITH e AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events),
measurements AS (SELECT
  strftime(ts, '%Y-%m-%d %H:%M:%S')                                              AS date,
  CAST(k % 7 AS INT)                                                             AS "busLineID",
  event_type                                                                     AS "busLinePatternID",
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END                               AS congestion,
  CAST(-6.30 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(1000 AS DOUBLE)               AS longitude,
  CAST(53.32 AS DOUBLE) + CAST((user_id % 15) * 4 AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
  CAST(floor(value) AS INT) - 20                                                 AS delay,
  CAST(33000 + user_id % 8 AS INT)                                               AS "vehicleID",
  CAST(CASE WHEN k % 12 = 0 THEN -1 ELSE 200 + k % 12 END AS INT)                AS "closerStopID",
  CASE WHEN event_type IN ('error', 'purchase') THEN 0 ELSE 1 END               AS "atStop"
FROM e)
"""
# The same with the keys that grow with the users.
WIDE_CTE = (
    MEASUREMENTS_CTE.replace(
        "CAST(k % 7 AS INT) ", "CAST(floor(user_id / 4) * 3 + k % 3 AS INT) "
    )
    .replace("33000 + user_id % 8 AS INT", "33000 + user_id AS INT")
    .replace("200 + k % 12 END", "200 + floor(user_id / 5) * 4 + k * k % 23 END")
)

_BOX = (
    "latitude BETWEEN 53.3343619 AND 53.3702027 "
    "AND longitude BETWEEN -6.2886331 AND -6.2043634"
)
_WINDOW = (
    "CAST(date AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-08 06:30:00' "
    "AND TIMESTAMP '2024-01-08 06:30:00' + INTERVAL 21600 SECOND"
)
_VEHICLE_DAY = "\"vehicleID\" = 33001 AND substr(date, 1, 10) = '2024-01-08'"
_ON_TIME = 'CASE WHEN delay BETWEEN -60 AND 60 THEN 1 ELSE 0 END AS "onTime"'

_SQL_BODIES: dict[str, str] = {
    "congestion_by_hour": f"""
SELECT substr(date, 12, 2) AS hour,
       round(CAST(count(*) FILTER (WHERE congestion = 1) AS DOUBLE) / count(*) * 100, 2) AS percentage,
       count(*) AS "numMeasurements",
       count(*) FILTER (WHERE congestion = 1) AS "congestionMeasurements"
FROM measurements
WHERE dayofweek(CAST(date AS TIMESTAMP)) BETWEEN 1 AND 5
  AND substr(date, 12, 2) IN ('07', '08', '09')
  AND {_BOX}
GROUP BY 1
HAVING count(*) FILTER (WHERE congestion = 1) > 0""",
    "congestion_by_hour_all_hours": f"""
SELECT substr(date, 12, 2) AS hour,
       round(CAST(count(*) FILTER (WHERE congestion = 1) AS DOUBLE) / count(*) * 100, 2) AS percentage,
       count(*) AS "numMeasurements",
       count(*) FILTER (WHERE congestion = 1) AS "congestionMeasurements"
FROM measurements
WHERE dayofweek(CAST(date AS TIMESTAMP)) BETWEEN 1 AND 5
  AND {_BOX}
GROUP BY 1
HAVING count(*) FILTER (WHERE congestion = 1) > 0""",
    "congestion_by_hour_joined": """
SELECT a.hour, a.n AS "numMeasurements", b.c AS "congestionMeasurements"
FROM (SELECT substr(date, 12, 2) AS hour, count(*) AS n FROM measurements GROUP BY 1) a
JOIN (SELECT substr(date, 12, 2) AS hour, count(*) AS c FROM measurements
      WHERE congestion = 1 GROUP BY 1) b
  ON a.hour = b.hour""",
    "first_arrivals": f"""
SELECT "busLineID" AS "lineID", "closerStopID" AS "stationID",
       substr(date, 12, 8) AS "arrivalTime", {_ON_TIME}
FROM (SELECT *, row_number() OVER (
        PARTITION BY "busLineID", "closerStopID"
        ORDER BY date, "busLinePatternID", congestion, longitude, latitude, delay) AS rn
      FROM measurements
      WHERE {_VEHICLE_DAY} AND "atStop" = 1) t
WHERE rn = 1""",
    "first_arrivals_by_delay": f"""
SELECT "busLineID" AS "lineID", "closerStopID" AS "stationID",
       min(substr(date, 12, 8)) AS "arrivalTime", {_ON_TIME}
FROM measurements
WHERE {_VEHICLE_DAY} AND "atStop" = 1
GROUP BY "busLineID", "closerStopID", delay""",
    "busiest_stops": f"""
SELECT "closerStopID" AS "stationID",
       list_sort(list(DISTINCT "vehicleID")) AS "sortedvehicleIDList"
FROM measurements
WHERE "atStop" = 1 AND {_WINDOW}
GROUP BY 1
QUALIFY rank() OVER (ORDER BY count(DISTINCT "vehicleID") DESC) = 1""",
    "busiest_stops_month": """
SELECT "closerStopID" AS "stationID",
       list_sort(list(DISTINCT "vehicleID")) AS "sortedvehicleIDList"
FROM measurements
WHERE "atStop" = 1
  AND CAST(date AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-01 00:00:00'
                                  AND TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 2678400 SECOND
GROUP BY 1
QUALIFY rank() OVER (ORDER BY count(DISTINCT "vehicleID") DESC) = 1""",
    "line_delay_average": """
SELECT "busLineID" AS "lineID",
       CAST(CASE WHEN count(*) = 1 THEN sum(delay) ELSE sum(abs(delay)) END AS DOUBLE)
         / count(*) AS average
FROM measurements WHERE "atStop" = 1 GROUP BY 1""",
    "line_abs_delay_average": """
SELECT "busLineID" AS "lineID", avg(abs(delay)) AS average
FROM measurements WHERE "atStop" = 1 GROUP BY 1""",
    "scan_measurements": """
SELECT date, "busLineID", "busLinePatternID", congestion, longitude, latitude, delay,
       "vehicleID", "closerStopID", "atStop"
FROM measurements""",
    "scan_measurements_csv_reader": """
SELECT date, "busLineID", "busLinePatternID", congestion, longitude, latitude, delay,
       "vehicleID", "closerStopID", "atStop"
FROM measurements""",
    "weekday_reports": """
SELECT date, "vehicleID" FROM measurements
WHERE dayofweek(CAST(date AS TIMESTAMP)) BETWEEN 1 AND 5""",
    "hour_in_list": """
SELECT date, substr(date, 12, 2) AS hour FROM measurements
WHERE substr(date, 12, 2) IN ('07', '08', '09')""",
    "congested_reports": """
SELECT date, "busLineID", congestion FROM measurements WHERE congestion = 1""",
    "in_box": f"""
SELECT date, longitude, latitude FROM measurements WHERE {_BOX}""",
    "vehicle_day": f"""
SELECT date, "vehicleID", substr(date, 1, 10) AS only_days FROM measurements
WHERE {_VEHICLE_DAY}""",
    "time_window": f"""
SELECT date, "vehicleID" FROM measurements WHERE {_WINDOW}""",
    "at_stop_times": """
SELECT "vehicleID", substr(date, 12, 8) AS only_hours FROM measurements WHERE "atStop" = 1""",
    "on_time_flag": f"""
SELECT date, delay, {_ON_TIME} FROM measurements""",
    "reports_per_hour": """
SELECT substr(date, 12, 2) AS hour, count(*) AS "numMeasurements"
FROM measurements GROUP BY 1""",
    "vehicles_per_stop": """
SELECT "closerStopID", list_sort(list(DISTINCT "vehicleID")) AS "vehicleIDs",
       CAST(count(DISTINCT "vehicleID") AS INT) AS "numVehicles"
FROM measurements WHERE "atStop" = 1 GROUP BY 1""",
    "max_vehicles": """
SELECT CAST(max(n) AS INT) AS max_size
FROM (SELECT count(DISTINCT "vehicleID") AS n FROM measurements
      WHERE "atStop" = 1 GROUP BY "closerStopID") t""",
    "weekday_counts": """
SELECT substr(date, 12, 2) AS hour, count(*) AS "numMeasurements",
       count(*) FILTER (WHERE congestion = 1) AS "congestionMeasurements"
FROM measurements WHERE dayofweek(CAST(date AS TIMESTAMP)) BETWEEN 1 AND 5
GROUP BY 1
HAVING count(*) FILTER (WHERE congestion = 1) > 0""",
    "vehicle_counts": """
SELECT "closerStopID", CAST(count(DISTINCT "vehicleID") AS INT) AS "numVehicles"
FROM measurements WHERE "atStop" = 1 GROUP BY 1""",
    "line_delay_sum_count": """
SELECT "busLineID", CAST(sum(abs(delay)) AS BIGINT) AS sum_delay, count(*) AS n
FROM measurements WHERE "atStop" = 1 GROUP BY 1""",
}

# Names whose SQL is another entry's, on the wide projection, or read back from a store.
_WIDE = {
    "first_arrivals_wide": "first_arrivals",
    "busiest_stops_wide": "busiest_stops",
    "busiest_stops_wide_month": "busiest_stops_month",
    "vehicles_per_stop_wide": "vehicles_per_stop",
    "max_vehicles_wide": "max_vehicles",
    "line_delay_average_wide": "line_delay_average",
    "line_abs_delay_average_wide": "line_abs_delay_average",
    "line_delay_sum_count_wide": "line_delay_sum_count",
    "congestion_by_hour_joined_wide": "congestion_by_hour_joined",
    "vehicles_per_stop_bitmap_wide": "vehicle_counts",
    "max_vehicles_bitmap_wide": "max_vehicles",
    "busiest_stops_bitmap_wide_month": "busiest_stops_month",
    "history_line_delay_average": "line_delay_average",
    "history_line_abs_delay_average": "line_abs_delay_average",
    "history_hourly_counts": "congestion_by_hour_joined",
    "history_weekday_counts": "weekday_counts",
    "history_vehicles_per_stop": "vehicle_counts",
    "history_vehicle_lists": "vehicles_per_stop",
    "replaced_measurements": "scan_measurements",
}
_STORED_SQL = {
    "store_measurements": "scan_measurements",
    "store_congestion_by_hour": "congestion_by_hour",
    "store_first_arrivals": "first_arrivals",
    "store_busiest_stops": "busiest_stops",
    "store_line_delay_average": "line_delay_average",
    "compacted_first_arrivals": "first_arrivals",
    "compacted_busiest_stops": "busiest_stops",
    "vehicles_per_stop_bitmap": "vehicle_counts",
    "busiest_stops_bitmap": "busiest_stops",
    "replayed_measurements": "scan_measurements",
    "landed_measurements": "scan_measurements",
    "box_store_reports": "in_box",
    "box_store_congestion_by_hour": "congestion_by_hour",
}
# Ordered answers: the entry they are the places of, and its order.
_ORDERED = {
    "ordered_congestion_by_hour": (
        MEASUREMENTS_CTE, "congestion_by_hour_all_hours", "percentage DESC, hour"
    ),
    "ordered_first_arrivals": (
        MEASUREMENTS_CTE, "first_arrivals", '"arrivalTime", "lineID", "stationID"'
    ),
    "ordered_busiest_stops_month": (MEASUREMENTS_CTE, "busiest_stops_month", '"stationID"'),
    "ordered_line_delay_average_wide": (WIDE_CTE, "line_delay_average", 'average, "lineID"'),
    "ordered_line_abs_delay_average_wide": (
        WIDE_CTE, "line_abs_delay_average", 'average, "lineID"'
    ),
}


def _without_no_stop(body: str) -> str:
    return body.replace('"atStop" = 1', '"atStop" = 1 AND "closerStopID" <> -1')


ORACLE_SQL: dict[str, str] = {
    **{name: MEASUREMENTS_CTE + _SQL_BODIES[name].strip() for name in _SQL_BODIES if name in QUERIES},
    **{name: WIDE_CTE + _SQL_BODIES[of].strip() for name, of in _WIDE.items()},
    **{name: MEASUREMENTS_CTE + _SQL_BODIES[of].strip() for name, of in _STORED_SQL.items()},
    **{
        name: f"{cte.rstrip()}, answer AS ({_SQL_BODIES[of].strip()})\n"
        f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position FROM answer"
        for name, (cte, of, order) in _ORDERED.items()
    },
    # the delay, which is not in the answer, is last in its order
    "ordered_first_arrivals_by_delay": MEASUREMENTS_CTE
    + f"""
SELECT "lineID", "stationID", "arrivalTime", "onTime",
       CAST(row_number() OVER (ORDER BY t, "lineID", "stationID", delay) AS INT) AS position
FROM (SELECT "busLineID" AS "lineID", "closerStopID" AS "stationID", delay, min(date) AS t,
             min(substr(date, 12, 8)) AS "arrivalTime", {_ON_TIME}
      FROM measurements
      WHERE {_VEHICLE_DAY} AND "atStop" = 1
      GROUP BY "busLineID", "closerStopID", delay) answer""",
    "first_arrivals_real": MEASUREMENTS_CTE
    + _without_no_stop(_SQL_BODIES["first_arrivals"].strip()),
    "first_arrivals_by_delay_wide": WIDE_CTE
    + _without_no_stop(_SQL_BODIES["first_arrivals_by_delay"].strip()),
    "busiest_stops_wide_real": WIDE_CTE
    + _without_no_stop(_SQL_BODIES["busiest_stops_month"].strip()),
}

assert set(ORACLE_SQL) == set(QUERIES)
