"""Session helpers and parameter validation."""

from __future__ import annotations

import pytest

from fleetlens.functions.predicates import _hour_numbers
from fleetlens.functions.timefmt import parse_day, window_bounds
from fleetlens.session import _checkpoint_root, shared_dir


def test_shared_dir_lives_under_checkpoint_dir(spark):
    root = _checkpoint_root(spark)
    assert root  # set by the environment or by the local fallback
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(root.rstrip("/") + "/x-") and a != b


def test_sql_settings_applied(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_static_settings_do_not_fail_on_a_running_session(spark, tmp_path):
    from fleetlens.session import get_session

    again = get_session(conf={"spark.sql.warehouse.dir": str(tmp_path), "spark.sql.ansi.enabled": "true"})
    assert again.conf.get("spark.sql.ansi.enabled") == "true"


def test_hour_list_normalisation():
    assert _hour_numbers(["07", "08", "09"]) == [7, 8, 9]
    assert _hour_numbers(["7", "24", "ab", 8, "23", "00"]) == [0, 23]
    assert _hour_numbers(["\uff10\uff17", " 7", "7 "]) == []  # fullwidth "07", padded


def test_parameter_validation():
    with pytest.raises(ValueError):
        window_bounds("2013-01-07 25:00:00", 60)
    with pytest.raises(ValueError):
        parse_day("2013-1-7x")
    lo, hi = window_bounds("2013-03-31 00:30:00", 3600)
    assert (hi - lo).total_seconds() == 3600  # wall clock, no DST jump


def test_checkpoint_fallback_when_unset(tmp_path):
    """Without spark.checkpoint.dir (no spark-defaults), local mode picks one folder."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from fleetlens.session import get_session, shared_dir, _checkpoint_root\n"
        "s = get_session('local[1]')\n"
        "if _checkpoint_root(s) is not None:\n"
        "    print('SET-ELSEWHERE'); raise SystemExit(0)\n"
        "a, b = shared_dir(s, 'x'), shared_dir(s, 'y')\n"
        "assert a.rsplit('/', 1)[0] == b.rsplit('/', 1)[0]\n"
        "s.range(3).write.parquet(a)\n"
        "print(s.read.parquet(a).count())\n"
    ) % root
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))  # an empty conf dir
    out = subprocess.run(
        [sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300
    )
    assert out.returncode == 0, out.stderr[-2000:]
    if "SET-ELSEWHERE" in out.stdout:
        pytest.skip("spark.checkpoint.dir is injected by the environment")
    assert out.stdout.strip().endswith("3")


def test_parameters_accept_date_objects():
    import datetime as dt

    assert parse_day(dt.date(2013, 1, 2)) == dt.date(2013, 1, 2)
    assert parse_day(dt.datetime(2013, 1, 2, 8, 0)) == dt.date(2013, 1, 2)
    lo, hi = window_bounds(dt.datetime(2013, 1, 7, 6, 30, 0, 500), 60)
    assert (lo, hi) == (dt.datetime(2013, 1, 7, 6, 30), dt.datetime(2013, 1, 7, 6, 31))
