"""CSV ingest: malformed rows go aside, the split never depends on the projection."""

from __future__ import annotations

import pytest
from conftest import lines_df

from fleetlens.schema import TYPED_SCHEMA
from fleetlens.sources import (
    ingest_csv_to_store,
    read_ingested,
    read_measurements,
    read_measurements_csv,
    write_measurements,
)
from fleetlens.sources.csv_ingest import parse_lines, split_parsed
from fleetlens.session import shared_dir
from fleetlens.sources.store import range_count

MALFORMED = """
2013-01-07 07:00:00,1,,0,-6.269634,53.360504,-90,33000,279,1
bad,row
2013-01-07 25:00:00,3,Q,1,-6.25,53.35,0,33000,500,1
2013-01-07 08:00:00,3,Q,1,-6.25,53.35,abc,33000,500,1
2013-01-07 08:00:00,"4",Q,1,-6.25,53.35,5,33000,500,1
2013-01-07 08:00:00,4,Q,1,-6.25,53.35,5,33000,500,1,EXTRA
"""


def _split(spark):
    return split_parsed(parse_lines(lines_df(spark, MALFORMED)))


def test_one_good_five_bad(spark):
    good, bad = _split(spark)
    assert good.count() == 1
    assert bad.count() == 5
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["busLineID", "date", "delay", "field_count", "field_count"]


def test_split_is_stable_under_projection(spark):
    good, bad = _split(spark)
    assert good.select("date").count() == 1
    assert good.select("delay").count() == 1
    assert bad.select("line").count() == 5
    assert good.filter("vehicleID = 33000").select("atStop").count() == 1


def test_good_row_values(spark):
    good, _ = _split(spark)
    r = good.collect()[0]
    assert good.schema == TYPED_SCHEMA
    assert r.date == "2013-01-07 07:00:00"
    assert r.busLinePatternID == ""  # empty pattern is allowed and kept as ""
    assert (r.longitude, r.latitude, r.delay, r.closerStopID) == (-6.269634, 53.360504, -90, 279)
    assert str(r.ts) == "2013-01-07 07:00:00" and str(r.day) == "2013-01-07"


def test_whitespace_and_strict_date(spark):
    text = """
  2013-01-07 07:00:00,1,A,0,-6.25,53.35,5,1,2,1  \t
2013-1-7 07:00:00,1,A,0,-6.25,53.35,5,1,2,1
2013-01-07,1,A,0,-6.25,53.35,5,1,2,1
2013-01-07 07:00:00,1,A,0,-6.25,53.35,1.5,1,2,1
"""
    good, bad = split_parsed(parse_lines(lines_df(spark, text)))
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["date", "date", "delay"]


def test_numbers_have_python_forms(spark):
    good = ["-6.25", "+.5", "5.", "1E-3", " 7 ", "inf", "-Infinity", "nan", "-NaN"]
    bad = ["-6.25f", "53.35d", "0x1p3", "1_0", "1e", ".", "", "+-1", "1 2", "\uff17"]
    row = "2013-01-07 07:00:00,1,A,0,{x},53.35,5,1,2,1"
    g, b = split_parsed(
        parse_lines(lines_df(spark, "\n".join(row.format(x=x) for x in good + bad)))
    )
    assert g.count() == len(good) and b.count() == len(bad)
    assert {r.reason for r in b.collect()} == {"longitude"}
    got = {repr(r.longitude) for r in g.collect()}
    assert got == {repr(float(x)) for x in good}


def test_csv_files_and_store_roundtrip(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "part1.csv").write_text(MALFORMED.strip() + "\n")
    good, bad = read_measurements_csv(spark, str(src))
    assert (good.count(), bad.count()) == (1, 5)

    dest = shared_dir(spark, "ingest-test")
    ingest_csv_to_store(spark, str(src), dest, batch="b1")
    good2, bad2 = read_ingested(spark, dest)
    assert (good2.count(), bad2.count()) == (1, 5)
    assert sorted(tuple(r) for r in good2.collect()) == sorted(tuple(r) for r in good.collect())

    store = shared_dir(spark, "store-test")
    write_measurements(good2, store)
    back = read_measurements(spark, store)
    assert back.schema == TYPED_SCHEMA
    assert back.count() == 1


def test_csv_reader_is_lenient(spark, tmp_path):
    from fleetlens.sources import read_measurements_csv_reader

    src = tmp_path / "in"
    src.mkdir()
    (src / "part1.csv").write_text(MALFORMED.strip() + "\n")
    df = read_measurements_csv_reader(spark, str(src))
    assert df.schema == TYPED_SCHEMA
    # every line comes through; bad cells are NULL instead of being reported
    assert df.count() == 6
    got = {r.date: r for r in df.collect()}
    assert got["2013-01-07 07:00:00"].delay == -90
    assert got["2013-01-07 25:00:00"].ts is None
    nulls = df.filter("busLineID IS NULL OR delay IS NULL OR ts IS NULL").count()
    assert nulls >= 3


def test_strip_matches_python_whitespace(spark):
    line = "2013-01-07 07:00:00,1,A,0,-6.25,53.35,5,1,2,1"
    text = f" 　{line}\x1f \n\t{line}\u0085"
    good, bad = split_parsed(parse_lines(lines_df(spark, text)))
    assert (good.count(), bad.count()) == (2, 0)
    assert {r.atStop for r in good.collect()} == {1}


ROW = "{day} {time},1,A,0,-6.25,53.35,{delay},1,2,1"


def _row(day, time="07:00:00", delay=5):
    return ROW.format(day=day, time=time, delay=delay)


class Landing:
    """Lines written to a file of their own and ingested as a batch."""

    def __init__(self, spark, tmp_path, dest):
        self.spark, self.tmp, self.dest, self.n = spark, tmp_path, dest, 0

    def ingest(self, batch, *lines):
        self.n += 1
        src = self.tmp / f"in{self.n}"
        src.mkdir()
        (src / "f.csv").write_text("\n".join(lines) + "\n")
        ingest_csv_to_store(self.spark, str(src), self.dest, batch=batch)

    def good(self):
        rows = read_ingested(self.spark, self.dest).good.collect()
        return sorted((r.date, r.delay) for r in rows)

    def bad(self):
        return sorted(r.line for r in read_ingested(self.spark, self.dest).bad.collect())


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path, shared_dir(spark, "landing-store"))


def test_a_late_row_leaves_its_day_alone(landing):
    first = [_row("2013-01-07", f"0{h}:00:00") for h in range(9)]
    landing.ingest("d07", *first)
    landing.ingest("d08", _row("2013-01-08"), _row("2013-01-07", "23:59:59"))
    assert len(landing.good()) == 11
    assert ("2013-01-07 23:59:59", 5) in landing.good()


def test_undated_bad_lines_of_every_batch_stay(landing):
    landing.ingest("a", _row("2013-01-07"), "undated junk 1")
    landing.ingest("b", _row("2013-01-08"), "undated junk 2")
    assert landing.bad() == ["undated junk 1", "undated junk 2"]


def test_a_corrected_batch_leaves_no_bad_row(landing):
    bad = _row("2013-01-07", delay="x")
    landing.ingest("a", _row("2013-01-07", "08:00:00"), bad)
    assert (len(landing.good()), landing.bad()) == (1, [bad])
    landing.ingest("a", _row("2013-01-07", "08:00:00"), _row("2013-01-07", delay=7))
    assert (len(landing.good()), landing.bad()) == (2, [])


def test_an_all_bad_rerun_leaves_no_good_row(landing):
    landing.ingest("a", _row("2013-01-07"))
    landing.ingest("b", _row("2013-01-07", "09:00:00"))
    landing.ingest("a", _row("2013-01-07", delay="x"))
    assert landing.good() == [("2013-01-07 09:00:00", 5)]
    assert len(landing.bad()) == 1


def test_the_same_batch_twice_is_once(landing):
    for _ in range(2):
        landing.ingest("2013-01-07", _row("2013-01-07"), "junk")
        landing.ingest("2013-01-08", _row("2013-01-08", delay=9))
    assert landing.good() == [("2013-01-07 07:00:00", 5), ("2013-01-08 07:00:00", 9)]
    assert landing.bad() == ["junk"]


def test_an_emptied_batch_has_no_rows(landing, tmp_path):
    landing.ingest("a", _row("2013-01-07"))
    landing.ingest("b", _row("2013-01-08"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "f.csv").write_text("")
    ingest_csv_to_store(landing.spark, str(tmp_path / "none"), landing.dest, batch="a")
    assert landing.good() == [("2013-01-08 07:00:00", 5)]


def test_batch_ids_and_missing_stores(spark, landing):
    for name in ("", "a/b", "../x", ".hidden", "a=b"):
        with pytest.raises(ValueError):
            landing.ingest(name, _row("2013-01-07"))
    with pytest.raises(FileNotFoundError):
        read_ingested(spark, shared_dir(spark, "no-store"))


def test_compaction_of_one_day_leaves_the_others(spark, landing):
    landing.ingest("a", _row("2013-01-07"), _row("2013-01-08"))
    out = shared_dir(spark, "compact-days")
    write_measurements(read_ingested(spark, landing.dest).good, out)
    landing.ingest("b", _row("2013-01-07", "09:00:00"), _row("2013-01-08", "09:00:00"))
    good = read_ingested(spark, landing.dest).good
    write_measurements(good, out, days=["2013-01-07"], cluster=True)
    got = sorted(r.date for r in read_measurements(spark, out).collect())
    assert got == ["2013-01-07 07:00:00", "2013-01-07 09:00:00", "2013-01-08 07:00:00"]
    write_measurements(good, out)
    assert read_measurements(spark, out).count() == 4


def test_ranges_follow_the_input(spark):
    assert [range_count(n) for n in (0, 1, 10**6, 10**9, 4 * 10**12)] == [1, 1, 1, 90, 357_628]
    assert range_count(1000, target_file_bytes=24 * 100) == 10
    assert [range_count(n, cores=8) for n in (0, 10**5, 3 * 10**6, 10**9)] == [1, 1, 8, 90]


def test_lenient_dates_match_no_time_predicate(spark, tmp_path):
    from fleetlens import operators as ops
    from fleetlens.sources import measurements_from_frame, read_measurements_csv_reader

    src = tmp_path / "in"
    src.mkdir()
    loose = "2013-1-7 8:05:09,1,A,0,-6.25,53.35,5,1,2,1"
    bare = "2013-01-07,1,A,0,-6.25,53.35,5,1,3,1"
    (src / "f.csv").write_text("\n".join([loose, bare, _row("2013-01-07", "09:00:00")]) + "\n")
    m = read_measurements_csv_reader(spark, str(src))
    for frame in (m, measurements_from_frame(m)):
        assert frame.filter("ts IS NULL").count() == 2
        out = ops.first_arrivals(frame, 1, "2013-01-07", 60).collect()
        assert [tuple(r) for r in out] == [(1, 2, "09:00:00", 1)]
    # a store gives such texts back as they came
    store = shared_dir(spark, "loose-store")
    write_measurements(m, store)
    back = sorted(map(tuple, read_measurements(spark, store).collect()), key=str)
    assert back == sorted(map(tuple, m.collect()), key=str)


def test_bad_rows_are_filed_by_their_day(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "f.csv").write_text(MALFORMED.strip() + "\n")
    dest = shared_dir(spark, "bad-days")
    ingest_csv_to_store(spark, str(src), dest, batch="b1")
    table = spark.read.parquet(f"{dest}/batches")
    days = sorted(
        (r.status, str(r.day)) for r in table.select("status", "day").distinct().collect()
    )
    # "bad,row" has no date prefix: the only undated row
    assert days == [("bad", "2013-01-07"), ("bad", "None"), ("good", "2013-01-07")]
    assert table.filter("status = 'bad' AND day IS NULL").count() == 1


def test_measurements_from_frame(spark):
    from pyspark.sql import types as T

    from fleetlens import operators as ops
    from fleetlens.sources import measurements_from_frame

    # the reference DataFrame jobs' schema: 32-bit floats for the coordinates
    float_schema = T.StructType(
        [
            T.StructField(f.name, T.FloatType() if f.name in ("longitude", "latitude")
                          else f.dataType, True)
            for f in TYPED_SCHEMA.fields[:10]
        ]
    )
    rows = [
        ("2013-01-07 08:00:00", 1, "A", 1, -6.25, 53.35, 10, 33145, 279, 0),
        ("2013-01-07 08:10:00", 1, "A", 0, -6.25, 53.35, 10, 33145, 279, 0),
    ]
    m = measurements_from_frame(spark.createDataFrame(rows, float_schema))
    assert m.schema == TYPED_SCHEMA
    # floats are widened through their decimal text: 53.35f -> 53.35, not 53.3499984...
    assert {(r.longitude, r.latitude) for r in m.collect()} == {(-6.25, 53.35)}
    assert [tuple(r) for r in ops.congestion_by_hour(m, hours=["08"]).collect()] == [
        ("08", 50.0, 2, 1)
    ]
