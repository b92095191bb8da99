"""Benchmark the headline questions on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_REPEAT (default 5), BENCH_COPIES (default 30: the ``big_`` queries run on so many copies
of the reports, 3 million rows at sf0.1). Prints ONE JSON line on stdout:

    {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is run once to warm up, then BENCH_REPEAT times back to back; the median is
reported (steady-state time per query); ``value`` sums the questions and ingests on the driver
table, so it compares over rounds, ``queries`` also has those over stores and the larger input. Results
are forced with the ``noop`` sink, so the whole plan runs and nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from fleetlens import operators as ops  # noqa: E402
from fleetlens.plans.registry import (  # noqa: E402
    ALL_HOURS,
    MONTH_SECONDS,
    MONTH_START,
    Q1_BOX,
    Q1_HOURS,
    Q2_DAY,
    Q2_DELAY_LIMIT,
    Q2_VEHICLE,
    Q3_HORIZON,
    Q3_START,
)
from fleetlens.schema import MEASUREMENT_COLUMNS, NO_STOP  # noqa: E402
from fleetlens.session import get_session, shared_dir  # noqa: E402
from fleetlens.sources import (  # noqa: E402
    ingest_csv_to_store,
    measurements_from_events,
    read_ingested,
    read_measurements,
    read_measurements_csv,
    write_measurements,
)


def _driver_memory() -> str:
    """Half the machine's memory, at most 8g (local mode: the driver JVM is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError):
        return "4g"
    return f"{max(1, min(8, total // 2 // 2**30))}g"


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = get_session(
        f"local[{cpus}]",
        app_name="fleetlens-bench",
        shuffle_partitions=max(2 * cpus, 8),
        conf={"spark.driver.memory": _driver_memory()},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def m():
        return measurements_from_events(spark, sf_dir)

    # CSV text for the ingest benchmark: written once, outside the timed region.
    csv_dir = shared_dir(spark, "bench-csv")
    (
        m()
        .select(*MEASUREMENT_COLUMNS)
        .write.option("header", "false")
        .option("quote", "")
        .option("escape", "")
        .csv(csv_dir)
    )

    def ingest():
        good, bad = read_measurements_csv(spark, csv_dir)
        _run(good)
        _run(bad)

    store_dir = shared_dir(spark, "bench-store")

    def ingest_to_store():
        # every repeat re-ingests the same batch: its rows are replaced
        ingest_csv_to_store(spark, csv_dir, store_dir, batch="bench")

    # A larger derived input (BENCH_COPIES fleets beside each other, keys that grow with them),
    # so that plans are timed rather than fixed cost.
    copies = int(os.environ.get("BENCH_COPIES", "30"))
    big_dir = shared_dir(spark, "bench-big")
    users = 1_000_000
    big = measurements_from_events(spark, sf_dir, keys="wide").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    )
    for key in ("vehicleID", "busLineID", "closerStopID"):
        moved = F.col(key) + F.col("copy") * users
        big = big.withColumn(key, F.when(F.col(key) == NO_STOP, F.col(key)).otherwise(moved))
    write_measurements(big.drop("copy"), big_dir, cluster=True)

    def b():
        return read_measurements(spark, big_dir)

    ingest_to_store()

    def s():
        return read_ingested(spark, store_dir).good

    headline = {
        "q1_congestion_by_hour": lambda: _run(
            ops.congestion_by_hour(m(), hours=Q1_HOURS, **Q1_BOX)
        ),
        "q1_joined_form": lambda: _run(ops.hourly_counts_joined(m())),
        "q2_first_arrivals": lambda: _run(
            ops.first_arrivals(m(), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT)
        ),
        "q2b_first_arrivals_by_delay": lambda: _run(
            ops.first_arrivals_by_delay(m(), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT)
        ),
        "q3_busiest_stops": lambda: _run(ops.busiest_stops(m(), Q3_START, Q3_HORIZON)),
        "q5_line_delay_average": lambda: _run(ops.line_delay_average(m())),
        "q5_abs_delay_average": lambda: _run(ops.line_abs_delay_average(m())),
        "s4_csv_ingest": ingest,
        "s4_csv_ingest_to_store": ingest_to_store,
        "store_q1": lambda: _run(ops.congestion_by_hour(s(), hours=Q1_HOURS, **Q1_BOX)),
        "store_q2": lambda: _run(ops.first_arrivals(s(), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT)),
        "store_q3": lambda: _run(ops.busiest_stops(s(), Q3_START, Q3_HORIZON)),
        "store_q5": lambda: _run(ops.line_delay_average(s())),
        "big_q1": lambda: _run(ops.congestion_by_hour(b(), hours=ALL_HOURS, **Q1_BOX)),
        "big_q2": lambda: _run(ops.first_arrivals(b(), Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT)),
        "big_q3_all": lambda: _run(
            ops.busiest_stops(b(), MONTH_START, MONTH_SECONDS, exclude_no_stop=True)
        ),
        "big_q5": lambda: _run(ops.line_delay_average(b())),
    }

    # Steady state per query: warm it up (JIT, codegen cache, file listing), then time
    # BENCH_REPEAT runs back to back and keep the median.
    timings: dict[str, float] = {}
    for name, fn in headline.items():
        fn()
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 4)

    sf_match = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(sf_match.group(1)) if sf_match else sf_dir
    print(
        json.dumps(
            {
                "metric": "total_median_sec",
                "value": round(
                    sum(t for q, t in timings.items() if not q.startswith(("store_", "big_"))), 4
                ),
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "cpus": cpus,
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
