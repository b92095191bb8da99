"""Hot-key check: run the questions on a copy of ``events`` where one key holds a third of
the rows, and report per-stage task balance and shuffle volume from Spark's event log.

    python -m fleetlens.plans.skew_check /root/testdata/sf0.1 [copies]

The copy is derived by Spark from the given table (``copies`` replicas with distinct user
ids, then every third event moved onto one user, one ``k`` and one day, i.e. one vehicle,
line and stop on 2024-01-08) and written under ``spark.checkpoint.dir``. The clustered store
write (the only full shuffle) is run on it too. What to look for: the map stages'
max task time close to the median, and shuffles that carry partial aggregates (a few rows
per map task and group) rather than the hot key's rows.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from fleetlens import operators as ops
from fleetlens.session import get_session, shared_dir
from fleetlens.sources import measurements_from_events, write_measurements
from fleetlens.sources.events import events_path

# The hot key (user 1 and k 13 -> vehicle 33001, line 1, stop 208; 2024-01-08).
HOT_USER = 1
HOT_PROPS = '{"k": 13}'
USER_STRIDE = 10_000_000


def _skewed_copy(spark, sf_dir: str, copies: int) -> str:
    ev = spark.read.parquet(events_path(sf_dir))
    if copies > 1:
        ev = ev.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        ev = ev.withColumn("user_id", F.col("user_id") + F.col("_c") * USER_STRIDE).drop("_c")
    hot = F.col("event_id") % 3 == 0
    ev = ev.withColumn("user_id", F.when(hot, F.lit(HOT_USER)).otherwise(F.col("user_id")))
    ev = ev.withColumn("props", F.when(hot, F.lit(HOT_PROPS)).otherwise(F.col("props")))
    # ... and onto one day, keeping the time of day: one vehicle-day holds a third of the rows
    on_hot_day = F.make_timestamp_ntz(
        F.lit(2024), F.lit(1), F.lit(8), F.hour("ts"), F.minute("ts"), F.second("ts")
    )
    ev = ev.withColumn("ts", F.when(hot, on_hot_day).otherwise(F.col("ts")))
    out = shared_dir(spark, "skewed-events")
    # several files, so the scan is spread over tasks as it would be on a real table
    ev.repartition(max(8, copies)).write.parquet(f"{out}/events.parquet")
    return out


def _stage_report(log_dir: str) -> list[str]:
    group_of, tasks = {}, {}
    for path in glob.glob(f"{log_dir.replace('file:', '')}/**", recursive=True):
        if not (os.path.isfile(path) and "events_" in os.path.basename(path)):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for st in e["Stage Infos"]:
                        group_of[st["Stage ID"]] = g
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    info = e["Task Info"]
                    tasks.setdefault(e["Stage ID"], []).append(
                        (
                            m.get("Input Metrics", {}).get("Records Read", 0),
                            m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0),
                            m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0),
                            info["Finish Time"] - info["Launch Time"],
                        )
                    )
    lines = ["| question | stage | tasks | max input rows | max shuffle-read rows | "
             "shuffle rows written | task ms max / median |", "|---|---|---|---|---|---|---|"]
    for st in sorted(tasks):
        if group_of.get(st) is None:
            continue
        ts = tasks[st]
        ms = [t[3] for t in ts]
        lines.append(
            f"| {group_of[st]} | {st} | {len(ts)} | {max(t[0] for t in ts)} | "
            f"{max(t[1] for t in ts)} | {sum(t[2] for t in ts)} | "
            f"{max(ms)} / {statistics.median(ms):g} |"
        )
    return lines


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    copies = int(argv[2]) if len(argv) > 2 else 1
    probe = get_session("local[8]", shuffle_partitions=16)
    log_dir = shared_dir(probe, "skew-eventlog")
    data_dir = _skewed_copy(probe, sf_dir, copies)
    probe.stop()
    os.makedirs(log_dir.replace("file:", ""), exist_ok=True)
    spark = get_session(
        "local[8]",
        shuffle_partitions=16,
        conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def m():
        return measurements_from_events(spark, data_dir, keys="wide")

    questions = {
        "Q1": lambda: ops.congestion_by_hour(
            m(), 90.0, 180.0, -90.0, -180.0, [f"{h:02d}" for h in range(24)]
        ),
        "Q2": lambda: ops.first_arrivals(m(), 33001, "2024-01-08", 60),
        "Q3": lambda: ops.busiest_stops(m(), "2024-01-01 00:00:00", 31 * 86400),
        "Q5": lambda: ops.line_delay_average(m()),
    }
    timings = {}
    for name, build in questions.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    spark.sparkContext.setJobGroup("store", "store")
    t0 = time.perf_counter()
    write_measurements(m(), shared_dir(spark, "skewed-store"), cluster=True)
    timings["store"] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(
        f"skewed copy of {sf_dir} x{copies}: one third of the rows on vehicle 33001, "
        "line 1, stop 208, day 2024-01-08; all other keys grow with the copies"
    )
    print(f"wall seconds: {timings}\n")
    print("\n".join(_stage_report(log_dir)))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
