"""Random small fixtures: Spark operators vs a plain-Python brute force of the same meaning."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from conftest import measurements, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlens import operators as ops

NORTH, EAST, SOUTH, WEST = 53.3702027, -6.2043634, 53.3343619, -6.2886331
HOURS = ["07", "08", "09"]

report = st.tuples(
    st.sampled_from(["2013-01-04", "2013-01-05", "2013-01-06", "2013-01-07"]),  # Fri..Mon
    st.integers(6, 10),  # hour
    st.sampled_from([0, 59]),  # minute
    st.sampled_from([0, 30, 59]),  # second
    st.integers(1, 3),  # line
    st.sampled_from(["", "A", "B"]),  # pattern
    st.integers(0, 1),  # congestion
    st.sampled_from([WEST, EAST, -6.25, -6.30]),  # longitude (edges included)
    st.sampled_from([SOUTH, NORTH, 53.35, 53.40]),  # latitude
    st.integers(-90, 90),  # delay
    st.sampled_from([1, 2, 3]),  # vehicle
    st.sampled_from([-1, 279, 500]),  # stop
    st.integers(0, 1),  # at stop
)


def _line(r):
    day, h, mi, sec, line, pat, cong, lon, lat, delay, veh, stop, at = r
    return f"{day} {h:02d}:{mi:02d}:{sec:02d},{line},{pat},{cong},{lon},{lat},{delay},{veh},{stop},{at}"


def _parsed(r):
    day, h, mi, sec, line, pat, cong, lon, lat, delay, veh, stop, at = r
    date = f"{day} {h:02d}:{mi:02d}:{sec:02d}"
    return (date, line, pat, cong, lon, lat, delay, veh, stop, at)


def _round2(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def brute_q1(recs):
    t, c = defaultdict(int), defaultdict(int)
    for date, _, _, cong, lon, lat, *_ in recs:
        d = dt.datetime.strptime(date, "%Y-%m-%d %H:%M:%S")
        hour = date[11:13]
        if d.weekday() < 5 and hour in HOURS and SOUTH <= lat <= NORTH and WEST <= lon <= EAST:
            t[hour] += 1
            c[hour] += cong == 1
    out = [(h, _round2(c[h] / t[h] * 100), t[h], c[h]) for h in t if c[h] > 0]
    return sorted(out, key=lambda x: (-x[1], x[0]))


def brute_q2(recs, vehicle, day, limit):
    groups = defaultdict(list)
    for r in recs:
        if r[7] == vehicle and r[0][:10] == day and r[9] == 1:
            groups[(r[1], r[8])].append(r)
    out = []
    for (line, stop), g in groups.items():
        first = min(g)  # whole-row order, as sorting the group's tuples
        out.append((line, stop, first[0][11:], 1 if -limit <= first[6] <= limit else 0))
    return sorted(out, key=lambda x: (x[2], x[0], x[1]))


def brute_q2b(recs, vehicle, day, limit):
    first = {}
    for r in recs:
        if r[7] == vehicle and r[0][:10] == day and r[9] == 1:
            key = (r[1], r[8], r[6])
            first[key] = min(first.get(key, r[0]), r[0])
    out = [
        (line, stop, t[11:], 1 if -limit <= delay <= limit else 0, delay)
        for (line, stop, delay), t in first.items()
    ]
    out.sort(key=lambda x: (x[2], x[0], x[1], x[4]))
    return [x[:4] for x in out]


def brute_j1(recs):
    t, c = defaultdict(int), defaultdict(int)
    for r in recs:
        t[r[0][11:13]] += 1
        c[r[0][11:13]] += r[3] == 1
    return sorted((h, t[h], c[h]) for h in t if c[h] > 0)


def brute_q3(recs, start, seconds):
    lo = dt.datetime.strptime(start, "%Y-%m-%d %H:%M:%S")
    hi = lo + dt.timedelta(seconds=seconds)
    sets = defaultdict(set)
    for r in recs:
        d = dt.datetime.strptime(r[0], "%Y-%m-%d %H:%M:%S")
        if lo <= d <= hi and r[9] == 1:
            sets[r[8]].add(r[7])
    if not sets:
        return []
    top = max(len(v) for v in sets.values())
    return sorted((k, sorted(v)) for k, v in sets.items() if len(v) == top)


def brute_q5(recs):
    delays = defaultdict(list)
    for r in recs:
        if r[9] == 1:
            delays[r[1]].append(r[6])
    out = []
    for line, ds in delays.items():
        avg = ds[0] if len(ds) == 1 else sum(abs(d) for d in ds) / len(ds)
        out.append((line, float(avg)))
    return sorted(out, key=lambda x: (x[1], x[0]))


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(report, min_size=1, max_size=40))
def test_operators_match_brute_force(spark, reports):
    m = measurements(spark, "\n".join(_line(r) for r in reports))
    recs = [_parsed(r) for r in reports]
    assert m.count() == len(recs)

    assert rows(ops.congestion_by_hour(m, NORTH, EAST, SOUTH, WEST, HOURS)) == brute_q1(recs)
    assert rows(ops.first_arrivals(m, 2, "2013-01-07", 60)) == brute_q2(recs, 2, "2013-01-07", 60)
    assert rows(ops.busiest_stops(m, "2013-01-07 07:00:00", 5400)) == [
        (k, v) for k, v in brute_q3(recs, "2013-01-07 07:00:00", 5400)
    ]
    assert rows(ops.line_delay_average(m)) == brute_q5(recs)
    assert rows(ops.first_arrivals_by_delay(m, 2, "2013-01-07", 60)) == brute_q2b(
        recs, 2, "2013-01-07", 60
    )
    assert sorted(rows(ops.hourly_counts_joined(m))) == brute_j1(recs)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(report, min_size=1, max_size=40))
def test_selections_match_brute_force(spark, reports):
    m = measurements(spark, "\n".join(_line(r) for r in reports))
    recs = [_parsed(r) for r in reports]

    def when(pred):
        return [r for r in recs if pred(r)]

    def dtime(r):
        return dt.datetime.strptime(r[0], "%Y-%m-%d %H:%M:%S")

    assert sorted(rows(ops.weekday_reports(m))) == sorted(
        (r[0], r[7]) for r in when(lambda r: dtime(r).weekday() < 5)
    )
    assert sorted(rows(ops.hour_in_list(m, HOURS))) == sorted(
        (r[0], r[0][11:13]) for r in when(lambda r: r[0][11:13] in HOURS)
    )
    assert sorted(rows(ops.in_box_reports(m, NORTH, EAST, SOUTH, WEST))) == sorted(
        (r[0], r[4], r[5])
        for r in when(lambda r: SOUTH <= r[5] <= NORTH and WEST <= r[4] <= EAST)
    )
    lo = dt.datetime(2013, 1, 7, 7, 0)
    hi = lo + dt.timedelta(seconds=5400)
    assert sorted(rows(ops.time_window(m, "2013-01-07 07:00:00", 5400))) == sorted(
        (r[0], r[7]) for r in when(lambda r: lo <= dtime(r) <= hi)
    )
    assert sorted(rows(ops.vehicle_day(m, 2, "2013-01-07"))) == sorted(
        (r[0], r[7], r[0][:10]) for r in when(lambda r: r[7] == 2 and r[0][:10] == "2013-01-07")
    )
    assert sorted(rows(ops.on_time_flag(m, 60))) == sorted(
        (r[0], r[6], 1 if -60 <= r[6] <= 60 else 0) for r in recs
    )


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(report, min_size=1, max_size=30))
def test_store_roundtrip_preserves_rows_and_answers(spark, tmp_path_factory, reports):
    from fleetlens.session import shared_dir
    from fleetlens.sources import ingest_csv_to_store, read_ingested

    src = tmp_path_factory.mktemp("csv")
    (src / "part.csv").write_text("\n".join(_line(r) for r in reports) + "\n")
    direct = measurements(spark, "\n".join(_line(r) for r in reports))
    dest = shared_dir(spark, "prop-store")
    ingest_csv_to_store(spark, str(src), dest, batch="b1")
    stored, bad = read_ingested(spark, dest)
    assert bad.count() == 0
    assert sorted(rows(stored)) == sorted(rows(direct))  # `date` re-derived exactly
    for q in (
        lambda x: ops.congestion_by_hour(x, NORTH, EAST, SOUTH, WEST, HOURS),
        lambda x: ops.first_arrivals(x, 2, "2013-01-07", 60),
        lambda x: ops.busiest_stops(x, "2013-01-07 07:00:00", 5400),
    ):
        assert rows(q(stored)) == rows(q(direct))
