"""The command line runs each question on CSV text, the CSV reader and the store."""

from __future__ import annotations

from test_fixtures import FX_Q1, FX_Q2, FX_Q3, FX_Q5

from fleetlens.cli import main
from fleetlens.session import shared_dir


def _csv(tmp_path, name, text):
    d = tmp_path / name
    d.mkdir()
    (d / "part.csv").write_text(text.strip() + "\n")
    return str(d)


def test_cli_prints_results(spark, tmp_path, capsys):
    src = _csv(tmp_path, "q1", FX_Q1)
    assert main(["congestion", "--input", src], spark=spark) == 0
    out = capsys.readouterr().out.strip().split("\n")
    assert out == [
        "hour\tpercentage\tnumMeasurements\tcongestionMeasurements",
        "09\t66.67\t3\t2",
        "08\t33.33\t3\t1",
    ]

    src = _csv(tmp_path, "q2", FX_Q2)
    main(["arrivals", "--input", src, "--vehicle", "33145", "--day", "2013-01-02"], spark=spark)
    assert capsys.readouterr().out.strip().split("\n")[1:] == [
        "1\t279\t08:00:00\t1",
        "1\t500\t08:05:00\t0",
        "2\t-1\t08:10:00\t1",
    ]

    src = _csv(tmp_path, "q3", FX_Q3)
    main(["busiest-stops", "--input", src, "--source", "csv-reader"], spark=spark)
    assert capsys.readouterr().out.strip().split("\n")[1:] == [
        "279\t[33000, 33145]",
        "500\t[28000, 33145]",
    ]


def test_cli_ingest_then_store(spark, tmp_path, capsys):
    src = _csv(tmp_path, "q5", FX_Q5)
    store = shared_dir(spark, "cli-store")
    assert main(["ingest", "--input", src, "--output", store, "--batch", "b1"], spark=spark) == 0
    main(["line-delay", "--input", store, "--source", "store"], spark=spark)
    assert capsys.readouterr().out.strip().split("\n")[1:] == ["1\t-7.0", "4\t0.0", "2\t4.0"]
    out = shared_dir(spark, "cli-out")
    main(["line-delay", "--input", store, "--source", "store", "--absolute", "--output", out],
         spark=spark)
    rows = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert rows == [(1, 7.0), (2, 4.0), (4, 0.0)]


def test_cli_arrivals_by_delay(spark, tmp_path, capsys):
    src = _csv(tmp_path, "q2b", FX_Q2)
    args = ["arrivals-by-delay", "--input", src, "--vehicle", "33145", "--day", "2013-01-02"]
    assert main(args, spark=spark) == 0
    assert capsys.readouterr().out.strip().split("\n")[1:] == [
        "1\t279\t08:00:00\t1",
        "1\t279\t08:00:20\t0",
        "1\t500\t08:05:00\t0",
        "2\t-1\t08:10:00\t1",
    ]


def test_cli_compact_then_query(spark, tmp_path, capsys):
    src = _csv(tmp_path, "q2c", FX_Q2)
    store = shared_dir(spark, "cli-compact-src")
    out = shared_dir(spark, "cli-compact-out")
    assert main(["ingest", "--input", src, "--output", store, "--batch", "b1"], spark=spark) == 0
    assert main(["compact", "--input", store, "--output", out, "--cluster", "time"], spark=spark) == 0
    main(["arrivals", "--input", out, "--source", "compacted"], spark=spark)
    assert capsys.readouterr().out.strip().split("\n")[1:] == [
        "1\t279\t08:00:00\t1",
        "1\t500\t08:05:00\t0",
        "2\t-1\t08:10:00\t1",
    ]


def test_cli_history_of_a_growing_landing_folder(spark, tmp_path, capsys):
    src = tmp_path / "landing"
    src.mkdir()
    lines = FX_Q5.strip().split("\n")
    store = shared_dir(spark, "cli-history")
    for k, part in enumerate((lines[::2], lines[1::2])):
        (src / f"{k}.csv").write_text("\n".join(part) + "\n")
        args = ["ingest-new", "--input", str(src), "--output", store, "--batch", f"b{k}"]
        assert main(args, spark=spark) == 0
        assert main(["refresh-states", "--input", store], spark=spark) == 0
    main(["history", "line-delay", "--input", store], spark=spark)
    assert capsys.readouterr().out.strip().split("\n")[1:] == ["1\t-7.0", "4\t0.0", "2\t4.0"]
    main(["vacuum", "--input", store, "--keep", "1"], spark=spark)
    main(["history", "stops", "--input", store], spark=spark)
    assert capsys.readouterr().out.startswith("closerStopID\tnumVehicles\n")
    out = shared_dir(spark, "cli-box")
    assert main(["compact", "--input", store, "--output", out, "--cluster", "box"], spark=spark) == 0
    main(["line-delay", "--input", out, "--source", "compacted"], spark=spark)
    assert capsys.readouterr().out.strip().split("\n")[1:] == ["1\t-7.0", "4\t0.0", "2\t4.0"]
