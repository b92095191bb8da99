"""The hand-made fixtures of FIXTURES.md section 3: exact rows, in order."""

from __future__ import annotations

from conftest import measurements, rows

from fleetlens import operators as ops

FX_Q1 = """
2013-01-07 08:00:00,1,027B1001,1,-6.25,53.35,10,33145,279,0
2013-01-07 08:10:00,1,027B1001,0,-6.2043634,53.3343619,10,33145,279,0
2013-01-07 08:20:00,1,,0,-6.2886331,53.3702027,10,33145,279,0
2013-01-07 09:00:00,2,X,1,-6.25,53.35,10,33000,500,0
2013-01-07 09:10:00,2,X,1,-6.25,53.35,10,33000,500,0
2013-01-07 09:59:59,2,X,0,-6.25,53.35,10,33000,500,0
2013-01-07 07:30:00,2,X,0,-6.25,53.35,10,33000,500,0
2013-01-05 09:00:00,2,X,1,-6.25,53.35,10,33000,500,0
2013-01-07 10:00:00,2,X,1,-6.25,53.35,10,33000,500,0
2013-01-07 09:20:00,2,X,1,-6.30,53.35,10,33000,500,0
"""

FX_Q2 = """
2013-01-02 08:00:00,1,A,0,-6.25,53.35,60,33145,279,1
2013-01-02 08:00:20,1,A,0,-6.25,53.35,75,33145,279,1
2013-01-02 08:05:00,1,A,0,-6.25,53.35,-61,33145,500,1
2013-01-02 08:10:00,2,B,0,-6.25,53.35,0,33145,-1,1
2013-01-02 08:02:00,1,A,0,-6.25,53.35,0,33145,500,0
2013-01-03 08:00:00,1,A,0,-6.25,53.35,0,33145,279,1
2013-01-02 07:00:00,1,A,0,-6.25,53.35,0,33000,279,1
"""

FX_Q3 = """
2013-01-07 06:30:00,1,A,0,-6.25,53.35,0,33145,279,1
2013-01-07 06:40:00,1,A,0,-6.25,53.35,0,33000,279,1
2013-01-07 06:45:00,1,A,0,-6.25,53.35,0,33145,279,1
2013-01-07 06:50:00,1,A,0,-6.25,53.35,0,33145,500,1
2013-01-07 07:00:00,1,A,0,-6.25,53.35,0,28000,500,1
2013-01-07 06:50:00,1,A,0,-6.25,53.35,0,33000,600,1
2013-01-07 07:00:01,1,A,0,-6.25,53.35,0,99999,279,1
2013-01-07 06:55:00,1,A,0,-6.25,53.35,0,88888,600,0
"""

FX_Q5 = """
2013-01-07 06:30:00,1,A,0,-6.25,53.35,-7,33145,279,1
2013-01-07 06:30:00,2,A,0,-6.25,53.35,-7,33145,279,1
2013-01-07 06:31:00,2,A,0,-6.25,53.35,3,33145,279,1
2013-01-07 06:32:00,2,A,0,-6.25,53.35,-2,33145,279,1
2013-01-07 06:33:00,3,A,0,-6.25,53.35,90,33145,279,0
2013-01-07 06:34:00,4,A,0,-6.25,53.35,0,33145,279,1
"""


def test_q1_congestion_by_hour(spark):
    m = measurements(spark, FX_Q1)
    out = ops.congestion_by_hour(m)
    assert out.columns == ["hour", "percentage", "numMeasurements", "congestionMeasurements"]
    # hour 07 has no congested report -> absent; both box corners count
    assert rows(out) == [("09", 66.67, 3, 2), ("08", 33.33, 3, 1)]


def test_q1_hours_are_two_character_strings(spark):
    m = measurements(spark, FX_Q1)
    assert rows(ops.congestion_by_hour(m, hours=["8", "9"])) == []
    assert rows(ops.congestion_by_hour(m, hours=["08"])) == [("08", 33.33, 3, 1)]


def test_q1_box_edges_inclusive(spark):
    m = measurements(spark, FX_Q1)
    # shrink the box to the single corner point of row 2 (south-east corner)
    out = ops.congestion_by_hour(
        m, north=53.3343619, east=-6.2043634, south=53.3343619, west=-6.2043634, hours=["08"]
    )
    assert rows(out) == []  # row 2 is in the box but not congested
    assert ops.hour_in_list(m, ["08"]).count() == 3
    # default box: both corner rows are inside, the row at longitude -6.30 is not
    assert ops.in_box_reports(m).count() == 9


def test_q1_join_form_agrees(spark):
    m = measurements(spark, FX_Q1)
    joined = {r[0]: (r[1], r[2]) for r in rows(ops.hourly_counts_joined(m))}
    # whole table, no filters: hour 09 has 5 reports (4 congested), hour 10 one congested
    assert joined["09"] == (5, 4)
    assert joined["08"] == (3, 1)
    assert joined["10"] == (1, 1)
    assert "07" not in joined  # no congested report at 07 -> dropped by the inner join


def test_q2_first_arrivals(spark):
    m = measurements(spark, FX_Q2)
    out = ops.first_arrivals(m, 33145, "2013-01-02", 60)
    assert out.columns == ["lineID", "stationID", "arrivalTime", "onTime"]
    assert rows(out) == [
        (1, 279, "08:00:00", 1),
        (1, 500, "08:05:00", 0),
        (2, -1, "08:10:00", 1),
    ]


def test_q2b_one_row_per_delay(spark):
    m = measurements(spark, FX_Q2)
    out = ops.first_arrivals_by_delay(m, 33145, "2013-01-02", 60)
    assert rows(out) == [
        (1, 279, "08:00:00", 1),
        (1, 279, "08:00:20", 0),
        (1, 500, "08:05:00", 0),
        (2, -1, "08:10:00", 1),
    ]


def test_q2_tie_break_is_whole_row(spark):
    # same second, same (line, stop): the lexicographically smaller pattern wins
    text = """
2013-01-02 08:00:00,1,B,0,-6.25,53.35,500,33145,279,1
2013-01-02 08:00:00,1,A,0,-6.25,53.35,0,33145,279,1
"""
    m = measurements(spark, text)
    assert rows(ops.first_arrivals(m, 33145, "2013-01-02", 60)) == [(1, 279, "08:00:00", 1)]


def test_q3_busiest_stops(spark):
    m = measurements(spark, FX_Q3)
    out = ops.busiest_stops(m, "2013-01-07 06:30:00", 1800)
    assert out.columns == ["stationID", "sortedvehicleIDList"]
    assert rows(out) == [(279, [33000, 33145]), (500, [28000, 33145])]


def test_q3_empty_window(spark):
    m = measurements(spark, FX_Q3)
    assert rows(ops.busiest_stops(m, "2020-01-01 00:00:00", 60)) == []


def test_q3_window_crossing_midnight(spark):
    text = """
2013-01-07 23:59:30,1,A,0,-6.25,53.35,0,1,7,1
2013-01-08 00:00:10,1,A,0,-6.25,53.35,0,2,7,1
2013-01-08 00:00:11,1,A,0,-6.25,53.35,0,3,7,1
"""
    m = measurements(spark, text)
    assert rows(ops.busiest_stops(m, "2013-01-07 23:59:30", 40)) == [(7, [1, 2])]


def test_q5_line_delay_average(spark):
    m = measurements(spark, FX_Q5)
    assert rows(ops.line_delay_average(m)) == [(1, -7.0), (4, 0.0), (2, 4.0)]


def test_q5_clean_variant(spark):
    m = measurements(spark, FX_Q5)
    assert rows(ops.line_abs_delay_average(m)) == [(4, 0.0), (2, 4.0), (1, 7.0)]
    assert sorted(rows(ops.line_delay_sum_count(m))) == [(1, 7, 1), (2, 12, 3), (4, 0, 1)]


def test_selections(spark):
    m = measurements(spark, FX_Q2)
    assert rows(ops.vehicle_day(m, 33145, "2013-01-02").orderBy("date")) == [
        ("2013-01-02 08:00:00", 33145, "2013-01-02"),
        ("2013-01-02 08:00:20", 33145, "2013-01-02"),
        ("2013-01-02 08:02:00", 33145, "2013-01-02"),
        ("2013-01-02 08:05:00", 33145, "2013-01-02"),
        ("2013-01-02 08:10:00", 33145, "2013-01-02"),
    ]
    assert ops.at_stop_times(m).count() == 6
    flags = dict(
        (r[0], r[2]) for r in rows(ops.on_time_flag(m, 60)) if r[0].startswith("2013-01-02 08:0")
    )
    assert flags["2013-01-02 08:00:00"] == 1 and flags["2013-01-02 08:05:00"] == 0
    assert ops.weekday_reports(m).count() == 7  # Wed / Thu
    assert ops.congested_reports(m).count() == 0


def test_q3_null_vehicle_is_not_counted(spark):
    from fleetlens.schema import MEASUREMENTS_SCHEMA

    base = ("2013-01-07 06:40:00", 1, "A", 0, -6.25, 53.35, 0)
    data = [
        base + (1, 7, 1),
        base + (2, 7, 1),
        base + (None, 8, 1),
        base + (None, 8, 1),
        base + (3, 8, 1),
    ]
    from pyspark.sql import functions as F

    m = spark.createDataFrame(data, MEASUREMENTS_SCHEMA)
    m = m.withColumn("ts", F.col("date").try_cast("timestamp_ntz")).withColumn(
        "day", F.to_date("ts")
    )
    assert rows(ops.busiest_stops(m, "2013-01-07 06:30:00", 1800)) == [(7, [1, 2])]
    assert sorted(rows(ops.vehicles_per_stop(m))) == [(7, [1, 2], 2), (8, [3], 1)]


def test_operator_names_missing_columns(spark):
    import pytest

    raw = spark.createDataFrame([("2013-01-07 08:00:00", 1)], "date string, busLineID int")
    with pytest.raises(ValueError, match="measurements_from_frame"):
        ops.congestion_by_hour(raw)


def test_q2_defaults_are_the_reference_parameters(spark):
    m = measurements(spark, FX_Q2)
    assert rows(ops.first_arrivals(m)) == rows(ops.first_arrivals(m, 33145, "2013-01-02", 60))


def test_edge_parameters(spark):
    m1 = measurements(spark, FX_Q1)
    # north below south: an empty box, nothing selected
    assert rows(ops.congestion_by_hour(m1, north=53.0, south=54.0)) == []
    # duplicate hours behave like one
    assert rows(ops.congestion_by_hour(m1, hours=["08", "08"])) == [("08", 33.33, 3, 1)]
    m3 = measurements(spark, FX_Q3)
    # a negative horizon ends before it starts: empty, as in the reference
    assert rows(ops.busiest_stops(m3, "2013-01-07 07:00:00", -60)) == []
    # a zero horizon keeps exactly the reports at the start second
    assert rows(ops.busiest_stops(m3, "2013-01-07 06:30:00", 0)) == [(279, [33145])]
    m2 = measurements(spark, FX_Q2)
    # a day with no reports for the vehicle
    assert rows(ops.first_arrivals(m2, 33145, "2013-01-05", 60)) == []
