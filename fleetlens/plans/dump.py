"""Write the executed plans of the headline queries as Markdown.

    python -m fleetlens.plans.dump /root/testdata/sf0.1 > PLANS.md

Each query is run once so the adaptive plan shown is the final one: coalesced shuffles,
broadcasts chosen at run time, reused exchanges. These results are small by construction
(per hour / per line / per stop / one vehicle-day), so the tool collects them; a write would
execute a different plan object and leave this one unfinalised.
"""

from __future__ import annotations

import re
import sys

from fleetlens import operators as ops
from fleetlens.plans.inspect import plan_string
from fleetlens.plans.registry import (
    Q1_BOX,
    Q1_HOURS,
    Q2_DAY,
    Q2_DELAY_LIMIT,
    Q2_VEHICLE,
    Q3_HORIZON,
    Q3_START,
    QUERIES,
)
from fleetlens.session import get_session, shared_dir
from fleetlens.sources import measurements_from_events, read_measurements, write_measurements

HEADLINE = [
    "congestion_by_hour",
    "congestion_by_hour_joined",
    "first_arrivals",
    "first_arrivals_by_delay",
    "busiest_stops",
    "line_delay_average",
    "line_abs_delay_average",
    "busiest_stops_bitmap",
    "history_line_delay_average",
    "history_vehicles_per_stop",
    "box_store_congestion_by_hour",
]


def _final_plan(text: str) -> str:
    final = text.split("+- == Initial Plan ==")[0]
    # long scan descriptions: keep what matters for review
    final = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", final)
    return re.sub(r"file:/[^\s,\]]*", "...", final)


def _show(title: str, df) -> None:
    df.collect()
    print(f"## {title}\n\n```")
    print(_final_plan(plan_string(df, "simple")).rstrip())
    print("```\n")


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Executed plans ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `python -m fleetlens.plans.dump`. Final adaptive plans after one run.\n")
    for name in HEADLINE:
        _show(name, QUERIES[name](spark, sf_dir))

    # The at-scale path: the same questions over the clustered, day-partitioned store.
    store = shared_dir(spark, "plans-store")
    write_measurements(measurements_from_events(spark, sf_dir), store, cluster=True)
    print("# Over the day-partitioned store (`write_measurements(..., cluster=True)`)\n")
    print("Weekday and day filters become PartitionFilters; vehicle, flag and box filters are")
    print("PushedFilters checked against parquet statistics.\n")
    stored = read_measurements(spark, store)
    _show("store: congestion_by_hour", ops.congestion_by_hour(stored, hours=Q1_HOURS, **Q1_BOX))
    _show(
        "store: first_arrivals",
        ops.first_arrivals(stored, Q2_VEHICLE, Q2_DAY, Q2_DELAY_LIMIT),
    )
    _show("store: busiest_stops", ops.busiest_stops(stored, Q3_START, Q3_HORIZON))
    _show("store: line_delay_average", ops.line_delay_average(stored))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
