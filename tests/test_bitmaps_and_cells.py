"""Distinct vehicles as bitmaps, and the map cell, against plain Python."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens import operators as ops
from fleetlens.functions import box_ranges, cell_in_box, cell_of, in_box
from fleetlens.functions.morton import STEPS, step
from fleetlens.operators.bitmaps import vehicle_bitmaps, vehicle_lists

EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 2**31 - 1, -(2**31), None]


def test_every_number_is_one_bit(spark):
    rng = random.Random(1)
    rows = [(s, v, 1) for s in (1, -1, None) for v in EDGES]
    rows += [(2, rng.randrange(-100_000, 100_000), 1) for _ in range(500)] + [(3, None, 1), (4, 5, 0)]
    m = spark.createDataFrame(rows + rows, "closerStopID int, vehicleID int, atStop int")
    plain = {}
    for s, v, at in rows:
        if at == 1:
            plain.setdefault(s, set()).update([] if v is None else [v])
    got = {r[0]: (r[1], r[2]) for r in vehicle_lists(_merged(m)).collect()}
    assert got == {s: (sorted(v), len(v)) for s, v in plain.items()}
    counts = {tuple(r) for r in ops.vehicles_per_stop_bitmap(m).collect()}
    assert counts == {(s, len(v)) for s, v in plain.items()}
    assert ops.max_vehicles_bitmap(m).first()[0] == max(map(len, plain.values()))


def _merged(m):
    return vehicle_bitmaps(m.filter("atStop = 1"))


def test_no_reports(spark):
    m = spark.createDataFrame([], "closerStopID int, vehicleID int, atStop int, ts timestamp_ntz, day date")
    assert ops.vehicles_per_stop_bitmap(m).count() == 0
    assert ops.max_vehicles_bitmap(m).first()[0] is None
    assert ops.busiest_stops_bitmap(m).count() == 0


coordinate = st.floats(-200, 200) | st.sampled_from([-90.0, 90.0, -180.0, 180.0, 53.35, -6.25, math.inf, -math.inf])


@settings(max_examples=200, deadline=None)
@given(coordinate, coordinate, coordinate, coordinate, st.integers(1, 40), st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1)), max_size=20))
def test_ranges_cover_the_box(a, b, c, d, n, inner):
    south, north, west, east = min(a, b), max(a, b), min(c, d), max(c, d)
    ranges = box_ranges(north, east, south, west, n)
    assert 1 <= len(ranges) <= n
    assert all(x <= y for x, y in ranges) and all(p[1] < q[0] for p, q in zip(ranges, ranges[1:]))
    points = [(south, west), (north, east), (south, east), (north, west)]
    if all(map(math.isfinite, (south, north, west, east))):
        points += [
            (min(max(south + u * (north - south), south), north), min(max(west + v * (east - west), west), east))
            for u, v in inner
        ]
    for lat, lon in points:
        z = 0
        y, x = step(lat, "latitude"), step(lon, "longitude")
        assert 0 <= y < STEPS and 0 <= x < STEPS
        for i in range(20):
            z |= (y >> i & 1) << 2 * i + 1 | (x >> i & 1) << 2 * i
        assert any(low <= z <= high for low, high in ranges)


def test_ranges_are_tight_and_bad_boxes_are_empty():
    cells = sum(y - x + 1 for x, y in box_ranges(53.3702027, -6.2043634, 53.3343619, -6.2886331))
    high = step(53.3702027, "latitude") - step(53.3343619, "latitude") + 1
    wide = step(-6.2043634, "longitude") - step(-6.2886331, "longitude") + 1
    assert high * wide <= cells <= 2 * high * wide
    assert box_ranges(1.0, 1.0, 2.0, 0.0) == [] and box_ranges(math.nan, 1.0, 0.0, 0.0) == []


def test_cells_in_spark_are_those_of_the_ranges(spark):
    box = (53.3702027, -6.2043634, 53.3343619, -6.2886331)
    rng = random.Random(2)
    rows = [(rng.uniform(53.3, 53.4), rng.uniform(-6.35, -6.15)) for _ in range(3000)]
    rows += [(a, b) for a in (box[0], box[2]) for b in (box[1], box[3])]  # corners are inside
    rows += [(math.nan, -6.25), (math.inf, -math.inf), (None, -6.25), (53.35, None), (95.0, 185.0)]
    points = spark.createDataFrame(rows, "latitude double, longitude double")
    lat, lon = F.col("latitude"), F.col("longitude")
    marked = points.select(
        "latitude", "longitude", in_box(lat, lon, *box).alias("inside"),
        cell_in_box(cell_of(lat, lon), *box).alias("cell"),
    ).collect()
    assert sum(bool(r.inside) for r in marked) > 400
    assert all(r.cell for r in marked if r.inside)
    assert sum(bool(r.cell) for r in marked) < 2 * sum(bool(r.inside) for r in marked)
    for r in points.withColumn("z", cell_of(lat, lon)).collect():
        if r.latitude is not None and r.longitude is not None and not math.isnan(r.latitude):
            y, x = step(r.latitude, "latitude"), step(r.longitude, "longitude")
            z = sum((y >> i & 1) << 2 * i + 1 | (x >> i & 1) << 2 * i for i in range(20))
            assert r.z == z
        elif r.latitude is None or r.longitude is None:
            assert r.z is None


@pytest.mark.parametrize("exclude", [False, True])
def test_excluding_reports_near_no_stop(spark, exclude):
    from conftest import measurements

    m = measurements(
        spark,
        """
2013-01-02 08:00:00,1,A,0,-6.25,53.35,10,33145,-1,1
2013-01-02 08:01:00,1,A,0,-6.25,53.35,-70,33145,279,1
2013-01-02 08:02:00,1,A,0,-6.25,53.35,10,33146,-1,1
""",
    )
    got = [tuple(r) for r in ops.first_arrivals(m, 33145, "2013-01-02", 60, exclude_no_stop=exclude).collect()]
    near = (1, 279, "08:01:00", 0)
    assert got == ([near] if exclude else [(1, -1, "08:00:00", 1), near])
    for f in (ops.busiest_stops, ops.busiest_stops_bitmap):
        top = [tuple(r) for r in f(m, "2013-01-02 07:00:00", 7200, exclude_no_stop=exclude).collect()]
        assert top == ([(279, [33145])] if exclude else [(-1, [33145, 33146])])
