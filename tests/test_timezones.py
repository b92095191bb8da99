"""Results do not depend on the session time zone, even inside a daylight-saving gap."""

from __future__ import annotations

import pytest
from conftest import measurements, rows

from fleetlens import operators as ops

# 2013-03-31 01:00-02:00 does not exist in Europe/Dublin (clocks jump to 02:00); the reports
# are wall-clock text, so they must come through unchanged.
GAP = """
2013-03-31 01:30:00,1,A,0,-6.25,53.35,10,33145,279,1
2013-03-31 01:45:00,1,A,0,-6.25,53.35,10,33000,279,1
2013-03-31 02:10:00,2,A,0,-6.25,53.35,90,33145,500,1
"""


@pytest.fixture
def dublin(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Dublin")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_gap_times_are_kept(dublin):
    m = measurements(dublin, GAP)
    assert m.count() == 3  # the strict date check accepts wall-clock gap times
    assert rows(ops.first_arrivals(m, 33145, "2013-03-31", 60)) == [
        (1, 279, "01:30:00", 1),
        (2, 500, "02:10:00", 0),
    ]
    assert rows(ops.busiest_stops(m, "2013-03-31 01:30:00", 900)) == [(279, [33000, 33145])]
    assert sorted(rows(ops.hour_in_list(m, ["01"]))) == [
        ("2013-03-31 01:30:00", "01"),
        ("2013-03-31 01:45:00", "01"),
    ]
    assert rows(ops.reports_per_hour(m).orderBy("hour")) == [("01", 2), ("02", 1)]


def test_registry_same_in_any_zone(spark):
    from conftest import SF_SMALL

    from fleetlens.plans.registry import QUERIES

    q = QUERIES
    names = ["congestion_by_hour", "first_arrivals", "busiest_stops", "vehicle_day"]
    utc = {n: sorted(rows(q[n](spark, SF_SMALL))) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = {n: sorted(rows(q[n](spark, SF_SMALL))) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_registry_same_with_ansi_off(spark):
    from conftest import SF_SMALL

    from fleetlens.plans.registry import QUERIES

    q = QUERIES
    names = ["congestion_by_hour", "first_arrivals_by_delay", "line_delay_average", "in_box"]
    on = {n: sorted(rows(q[n](spark, SF_SMALL))) for n in names}
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        off = {n: sorted(rows(q[n](spark, SF_SMALL))) for n in names}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert on == off
