"""Command line: run one question on a dataset, the way the reference's scripts are run.

    python -m fleetlens congestion --input DIR --north 53.37 --east -6.20 --south 53.33 \
        --west -6.29 --hours 07 08 09
    python -m fleetlens arrivals --input DIR --vehicle 33145 --day 2013-01-02 --delay-limit 60
    python -m fleetlens busiest-stops --input DIR --start "2013-01-07 06:30:00" --horizon 1800
    python -m fleetlens line-delay --input DIR [--absolute]
    python -m fleetlens ingest --input DIR --output STORE --batch 2013-01-07
    python -m fleetlens compact --input STORE --output COMPACTED [--cluster vehicle|time|box|none]
        [--days 2013-01-07 2013-01-08]
    python -m fleetlens ingest-new --input LANDING --output STORE --batch 2013-01-08
    python -m fleetlens refresh-states --input STORE
    python -m fleetlens history line-delay|hours|stops --input STORE
    python -m fleetlens vacuum --input STORE --keep 10

``--source csv`` (default) parses CSV text strictly, ``--source csv-reader`` uses the schema
reader, ``--source store`` reads a store written by ``ingest`` and ``--source compacted`` one
written by ``compact``. With ``--output`` the result is
written as parquet by the executors; without it, rows are streamed to stdout one partition at
a time (``toLocalIterator``), never collected whole.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from fleetlens import operators as ops
from fleetlens.operators.congestion import (
    DEFAULT_EAST,
    DEFAULT_HOURS,
    DEFAULT_NORTH,
    DEFAULT_SOUTH,
    DEFAULT_WEST,
)
from fleetlens.operators.occupancy import DEFAULT_HORIZON_SECONDS, DEFAULT_START
from fleetlens.operators.timetable import DEFAULT_DAY, DEFAULT_DELAY_LIMIT, DEFAULT_VEHICLE
from fleetlens.session import get_session
from fleetlens.sources import (
    ingest_csv_to_store,
    ingest_new_files,
    read_ingested,
    read_measurements,
    read_measurements_csv,
    read_measurements_csv_reader,
    read_states,
    refresh_states,
    vacuum,
    write_measurements,
)
from fleetlens.sources.store import BOX_KEY


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fleetlens", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp):
        sp.add_argument("--input", required=True, help="CSV file/dir/glob, or a store dir")
        sp.add_argument(
            "--source", choices=["csv", "csv-reader", "store", "compacted"], default="csv"
        )
        sp.add_argument("--output", help="write the result here as parquet")

    c = sub.add_parser("congestion", help="Q1: congested share per weekday hour in a box")
    common(c)
    c.add_argument("--north", type=float, default=DEFAULT_NORTH)
    c.add_argument("--east", type=float, default=DEFAULT_EAST)
    c.add_argument("--south", type=float, default=DEFAULT_SOUTH)
    c.add_argument("--west", type=float, default=DEFAULT_WEST)
    c.add_argument("--hours", nargs="+", default=DEFAULT_HOURS)

    for name, helptext in (
        ("arrivals", "Q2: first arrival per (line, stop) for a vehicle and day"),
        ("arrivals-by-delay", "Q2b: one row per distinct delay"),
    ):
        a = sub.add_parser(name, help=helptext)
        common(a)
        a.add_argument("--vehicle", type=int, default=DEFAULT_VEHICLE)
        a.add_argument("--day", default=DEFAULT_DAY, help="yyyy-MM-dd")
        a.add_argument("--delay-limit", type=int, default=DEFAULT_DELAY_LIMIT)
        a.add_argument(
            "--exclude-no-stop", action="store_true", help="leave out reports near no stop"
        )

    b = sub.add_parser("busiest-stops", help="Q3: stops with the most distinct vehicles")
    common(b)
    b.add_argument("--start", default=DEFAULT_START, help="yyyy-MM-dd HH:mm:ss")
    b.add_argument("--horizon", type=int, default=DEFAULT_HORIZON_SECONDS, help="seconds")
    b.add_argument("--exclude-no-stop", action="store_true", help="leave out reports near no stop")

    d = sub.add_parser("line-delay", help="Q5: average delay per line at stops")
    common(d)
    d.add_argument("--absolute", action="store_true", help="plain mean of |delay|")

    i = sub.add_parser("ingest", help="parse CSV once into the day-partitioned store")
    i.add_argument("--input", required=True)
    i.add_argument("--output", required=True)
    i.add_argument(
        "--batch", required=True,
        help="name of the landed batch; ingesting it again replaces its rows and no others",
    )
    i.add_argument(
        "--rebalance", action="store_true",
        help="shuffle by day before writing (input files that each span many days)",
    )

    k = sub.add_parser("compact", help="rewrite a store's good rows in a query-friendly layout")
    k.add_argument("--input", required=True, help="a store written by `ingest`")
    k.add_argument("--output", required=True)
    k.add_argument(
        "--cluster", choices=["vehicle", "time", "box", "none"], default="vehicle",
        help="vehicle: (day, vehicleID, ts) for vehicle lookups; time: (day, ts) for windows; "
        "box: (day, map cell, ts) for boxes",
    )
    k.add_argument("--rebalance", action="store_true", help="with --cluster none")
    k.add_argument(
        "--days", nargs="+", help="rewrite these days (yyyy-MM-dd) only; others stay as they are"
    )
    n = sub.add_parser("ingest-new", help="ingest the files of a landing folder that are new")
    n.add_argument("--input", required=True)
    n.add_argument("--output", required=True)
    n.add_argument("--batch", required=True, help="a name no batch of the store has yet")

    r = sub.add_parser("refresh-states", help="make the partial states that batches lack")
    r.add_argument("--input", required=True, help="a store written by `ingest`")

    h = sub.add_parser("history", help="answers over all history, from partial states")
    h.add_argument("question", choices=["line-delay", "hours", "stops"])
    h.add_argument("--input", required=True, help="a store written by `ingest`")
    h.add_argument("--output", help="write the result here as parquet")

    v = sub.add_parser("vacuum", help="remove versions that none of the last commits names")
    v.add_argument("--input", required=True, help="a store written by `ingest`")
    v.add_argument("--keep", type=int, default=10, help="commits whose versions stay")
    return p


HISTORY = {
    "line-delay": ("line_delays", ops.history_line_delay_average),
    "hours": ("hours", ops.history_hourly_counts),
    "stops": ("stop_vehicles", ops.history_vehicles_per_stop),
}


def _measurements(spark: SparkSession, args) -> DataFrame:
    if args.source == "store":
        return read_ingested(spark, args.input).good
    if args.source == "compacted":
        return read_measurements(spark, args.input)
    if args.source == "csv-reader":
        return read_measurements_csv_reader(spark, args.input)
    return read_measurements_csv(spark, args.input).good


def build(spark: SparkSession, args) -> DataFrame | None:
    if args.command == "ingest":
        ingest_csv_to_store(
            spark, args.input, args.output, batch=args.batch, rebalance=args.rebalance
        )
        return None
    if args.command == "compact":
        layouts = {"vehicle": True, "time": ("day", "ts"), "box": BOX_KEY, "none": False}
        cluster = layouts[args.cluster]
        good = read_ingested(spark, args.input).good
        write_measurements(
            good, args.output, cluster=cluster, rebalance=args.rebalance, days=args.days
        )
        return None
    if args.command == "ingest-new":
        ingest_new_files(spark, args.input, args.output, batch=args.batch)
        return None
    if args.command == "refresh-states":
        refresh_states(spark, args.input)
        return None
    if args.command == "vacuum":
        vacuum(spark, args.input, args.keep)
        return None
    if args.command == "history":
        kind, answer = HISTORY[args.question]
        return answer(read_states(spark, args.input, kind))
    m = _measurements(spark, args)
    if args.command == "congestion":
        return ops.congestion_by_hour(m, args.north, args.east, args.south, args.west, args.hours)
    if args.command == "arrivals":
        return ops.first_arrivals(
            m, args.vehicle, args.day, args.delay_limit, args.exclude_no_stop
        )
    if args.command == "arrivals-by-delay":
        return ops.first_arrivals_by_delay(
            m, args.vehicle, args.day, args.delay_limit, args.exclude_no_stop
        )
    if args.command == "busiest-stops":
        return ops.busiest_stops(m, args.start, args.horizon, args.exclude_no_stop)
    if args.command == "line-delay":
        return ops.line_abs_delay_average(m) if args.absolute else ops.line_delay_average(m)
    raise ValueError(args.command)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or get_session()
    result = build(spark, args)
    if result is None:
        return 0
    if args.output:
        result.write.mode("overwrite").parquet(args.output)
        return 0
    print("\t".join(result.columns))
    for row in result.toLocalIterator():
        print("\t".join(str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
