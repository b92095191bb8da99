"""Every registered query against its DuckDB statement on the whole sf0.01 tables."""

from __future__ import annotations

import pytest
from conftest import SF_ORACLE
from differential import compare, duck

from fleetlens.plans.registry import ORACLE_SQL as ORACLE
from fleetlens.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, con, SF_ORACLE, name, QUERIES[name], ORACLE[name])
    assert ok, msg


# FIXTURES.md section 1: Q1 / Q2 / Q2b / Q3 / Q5 result rows per scale factor
EXPECTED_SIZES = {
    "/root/testdata/sf0.001": (3, 2, 2, 1, 7),
    "/root/testdata/sf0.01": (3, 27, 30, 1, 7),
    "/root/testdata/sf0.1": (3, 76, 258, 10, 7),
}
SIZED = [
    "congestion_by_hour",
    "first_arrivals",
    "first_arrivals_by_delay",
    "busiest_stops",
    "line_delay_average",
]


@pytest.mark.parametrize("sf_dir", sorted(EXPECTED_SIZES))
def test_expected_result_sizes(spark, sf_dir):
    got = tuple(QUERIES[name](spark, sf_dir).count() for name in SIZED)
    assert got == EXPECTED_SIZES[sf_dir]


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["hour", "percentage", "numMeasurements", "congestionMeasurements"]
    assert df.count() == 3
