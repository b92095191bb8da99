from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from fleetlens.session import get_session  # noqa: E402
from fleetlens.sources.csv_ingest import parse_lines, split_parsed  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="fleetlens-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def lines_df(spark, text: str):
    rows = [(line,) for line in text.strip("\n").split("\n")]
    return spark.createDataFrame(rows, "value string")


def measurements(spark, text: str):
    """Good rows of a CSV fixture, through the real ingest expressions."""
    return split_parsed(parse_lines(lines_df(spark, text))).good


def rows(df):
    return [tuple(r) for r in df.collect()]
