"""Random lines: the Spark ingest vs the same rule written in plain Python."""

from __future__ import annotations

import datetime as dt

from conftest import lines_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlens.schema import MEASUREMENT_COLUMNS
from fleetlens.sources.csv_ingest import parse_lines, split_parsed

INTS = {"busLineID", "congestion", "delay", "vehicleID", "closerStopID", "atStop"}
DOUBLES = {"longitude", "latitude"}

int_text = st.one_of(
    st.integers(-100000, 100000).map(str),
    st.sampled_from(["+5", " 7", "8 ", "\t9", "-0", "", "abc", "1.5", '"4"', "0x10", "1e3"]),
)
float_text = st.one_of(
    st.floats(-1000, 1000, allow_nan=False).map(repr),
    st.sampled_from(["-6.25", " 53.35 ", "1e-3", ".5", "5.", "+1.5", "", "x", "1,5"]),
    # Java's forms, which float() does not read, and its own special values
    st.sampled_from(["-6.25f", "53.35d", "5F", "0x1p3", "1e", ".", "inf", "-Infinity", "5_"]),
)
date_text = st.one_of(
    st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 12, 31)).map(
        lambda d: d.strftime("%Y-%m-%d %H:%M:%S")
    ),
    st.sampled_from(
        [
            "2013-01-07 25:00:00",
            "2013-1-7 08:00:00",
            "2013-02-30 10:00:00",
            "2013-01-07",
            "2013-01-07T08:00:00",
            "bad",
            "",
        ]
    ),
)
pattern_text = st.sampled_from(["", "A", "027B1001", " x "])


@st.composite
def line(draw):
    fields = []
    for name in MEASUREMENT_COLUMNS:
        if name == "date":
            fields.append(draw(date_text))
        elif name in INTS:
            fields.append(draw(int_text))
        elif name in DOUBLES:
            fields.append(draw(float_text))
        else:
            fields.append(draw(pattern_text))
    shape = draw(st.sampled_from(["ok", "ok", "ok", "short", "long"]))
    if shape == "short":
        fields = fields[: draw(st.integers(1, 9))]
    elif shape == "long":
        fields = fields + ["extra"]
    pad = draw(st.sampled_from(["", " ", "  ", "\t"]))
    return pad + ",".join(fields) + draw(st.sampled_from(["", " "]))


def python_rule(text: str):
    """Good -> typed tuple, bad -> None."""
    parts = text.strip().split(",")
    if len(parts) != 10:
        return None
    out = []
    for name, raw in zip(MEASUREMENT_COLUMNS, parts):
        try:
            if name == "date":
                d = dt.datetime.strptime(raw, "%Y-%m-%d %H:%M:%S")
                if d.strftime("%Y-%m-%d %H:%M:%S") != raw:
                    return None
                out.append(raw)
            elif name in INTS:
                out.append(int(raw))
            elif name in DOUBLES:
                out.append(float(raw))
            else:
                out.append(raw)
        except ValueError:
            return None
    return tuple(out)


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(line(), min_size=1, max_size=30))
def test_ingest_matches_python_rule(spark, texts):
    good, bad = split_parsed(parse_lines(lines_df(spark, "\n".join(texts))))
    expected = [python_rule(t) for t in texts]
    want_good = sorted(e for e in expected if e is not None)
    got_good = sorted(tuple(r[c] for c in MEASUREMENT_COLUMNS) for r in good.collect())
    assert got_good == want_good
    assert bad.count() == sum(e is None for e in expected)
