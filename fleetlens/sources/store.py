"""Parquet stores for measurements.

At scale the CSV text is parsed once and written here; afterwards the day/window questions
read only the directories of the days they ask for (PartitionFilters) and only the columns
they use (ReadSchema), and the written table cuts the lineage back to the raw text, so a
lost executor costs a re-read of parquet, not a re-parse.

Two layouts:

* an *ingest store* holds every line ever ingested, good and bad, keyed by where it came from::

      dest/batches/batch=<id>/version=<v>/status=good|bad/day=.../    a version of a landing batch
      dest/streams/<name>/status=good|bad/day=.../                    one stream (its sink log beside)
      dest/states/<kind>/<write>/batch=<id>/version=<v>/              partial results (sources.states)
      dest/landed/batch=<id>/version=<v>/                             files a batch was made from
      dest/commits/<number>.json                                      what of these counts (sources.commits)

  A version's folder is written once and never changed. Ingesting a batch again, corrected or
  after a failure, writes another version and replaces all of the batch's rows by one commit, and
  no others, whatever days they fall on. A reader resolves the last commit once: it sees all old
  or all new rows, also while its plan is held over a commit. Versions that no kept commit names
  are removed by ``vacuum``; what a failed write left behind is never read.
* a *measurements store* (``dest/day=.../``) is derived from it by compaction: good rows only,
  whole days, optionally clustered.

Ingest writes good and bad rows in a single pass: one ``status`` partition column, so the
text is scanned exactly once and nothing is cached.

The ``date`` text is stored only where it is not ``ts`` rendered at second resolution (the
strict sources make no such rows); it is derived again on read. Stored for every row, it was
about 30% of the bytes.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions import cell_in_box, cell_of, in_box
from fleetlens.functions.timefmt import date_literal, instant_text, parse_day
from fleetlens.schema import TYPED_SCHEMA
from fleetlens.sources import commits
from fleetlens.sources.commits import folder_exists, folders
from fleetlens.sources.csv_ingest import BAD_COLUMNS, PARSER_VERSION, Ingest, parse_lines

GOOD = "good"
BAD = "bad"

# The layouts written below, declared so reads skip schema inference (a Spark job per read)
# and partition values get their types from here, not from guessing directory names.
# Typed columns kept in the files: everything but the partition `day`; `date` where it differs.
STORED_COLUMNS = [c for c in TYPED_SCHEMA.fieldNames() if c not in ("date", "day")]
_STORED_FIELDS = [f for f in TYPED_SCHEMA.fields if f.name in STORED_COLUMNS]
_DAY = T.StructField("day", T.DateType(), True)
MEASUREMENTS_STORE_SCHEMA = T.StructType(
    [
        *_STORED_FIELDS,
        T.StructField("date", T.StringType(), True),
        # the map cell, in stores clustered by it (functions.morton); NULL in others
        T.StructField("cell", T.LongType(), True),
        _DAY,
    ]
)
INGEST_STORE_SCHEMA = T.StructType(
    [
        *_STORED_FIELDS,
        T.StructField("line", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        _DAY,
    ]
)
_VERSION_FIELDS = [
    T.StructField("batch", T.StringType(), True),
    T.StructField("version", T.StringType(), True),
]
_BATCHES_SCHEMA = T.StructType([*INGEST_STORE_SCHEMA.fields, *_VERSION_FIELDS])
LANDED_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("length", T.LongType(), True),
        T.StructField("modified", T.TimestampType(), True),
        *_VERSION_FIELDS,
    ]
)

# Clustered files aim at this size. A stored report takes some 24 bytes (measured on the driver
# tables: 15 to 30 by codec and layout); the number of ranges follows from the rows.
TARGET_FILE_BYTES = 256 * 1024 * 1024
BYTES_PER_ROW = 24
LEAST_ROWS = 100_000

# Row groups without a vehicle are skipped by these filters (or by the dictionary, where a file's
# vehicles fit one), whatever the order of the rows. Sized for the vehicles of one day's file.
VEHICLES_PER_FILE = 100_000
BLOOM_OPTIONS = {
    "parquet.bloom.filter.enabled#vehicleID": "true",
    "parquet.bloom.filter.expected.ndv#vehicleID": str(VEHICLES_PER_FILE),
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number#vehicleID": "5",
}

_BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


# ---- folders ------------------------------------------------------------------------------


def _check_batch(batch: str) -> str:
    if not _BATCH_ID.fullmatch(batch):
        raise ValueError(f"a batch id has letters, digits, '.', '_' and '-' only: {batch!r}")
    return batch


def version_path(dest: str, batch: str, version: str, top: str = "batches") -> str:
    return f"{dest.rstrip('/')}/{top}/batch={_check_batch(batch)}/version={version}"


def stream_path(dest: str, name: str) -> str:
    if not _BATCH_ID.fullmatch(name):
        raise ValueError(f"a stream name has letters, digits, '.', '_' and '-' only: {name!r}")
    return f"{dest.rstrip('/')}/streams/{name}"


# ---- measurements store -------------------------------------------------------------------

# Fixed value: the default clustering key (day first: it is also the partition column).
CLUSTER_KEY = ["day", "vehicleID", "ts"]
# And the one for boxes on the map: time again cuts a crowded cell into ranges.
BOX_KEY = ["day", "cell", "ts"]


def write_measurements(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    cluster: bool | Sequence[str] = False,
    rebalance: bool = False,
    days: Iterable[str] | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Write typed measurements partitioned by ``day``.

    ``mode="overwrite"`` replaces the whole store. With ``days`` (``yyyy-MM-dd``) only rows of
    those days are written and only those days' partitions are replaced: ``df`` has to hold all
    rows of each (as a compaction from the ingest store does).

    ``cluster=False``: no shuffle; each task writes the days it holds (input files are
    normally time-ordered), so a hot day is never funnelled into a single task.

    ``rebalance=True``: for input that is not time-ordered, where every task would write a
    small file for every day it holds. A REBALANCE shuffle by day, which AQE splits for hot
    days and coalesces for small ones (``spark.sql.adaptive.advisoryPartitionSizeInBytes``),
    so each day gets a few files of the advisory size.

    ``cluster=True``: a one-off compaction. Rows are range-partitioned and sorted on
    (day, vehicleID, ts), so each file covers a narrow vehicle range and parquet min/max
    statistics let a vehicle filter (Q2) skip whole files and row groups. ``ts`` is part of
    the key so that one vehicle-day holding a large share of the rows is still cut into
    many ranges (a range partitioner cannot split a single key value). A workload of time
    windows (Q3) is better served by ``cluster=("day", "ts")``: row groups then cover short
    time spans and a window skips the rest of the day. The number of ranges follows the input:
    rows * ``BYTES_PER_ROW`` / ``target_file_bytes``, so a range fits one task at any scale
    (a small input is cut further, see ``range_count``).
    """
    differs = ~F.col("date").eqNullSafe(instant_text(F.col("ts")))
    out = df.select(*STORED_COLUMNS, F.when(differs, F.col("date")).alias("date"), "day")
    if days is not None:
        if mode != "overwrite":
            raise ValueError("days are replaced: mode has to be 'overwrite'")
        out = out.filter(F.col("day").isin([date_literal(parse_day(d)) for d in days]))
    if cluster:
        key = list(CLUSTER_KEY if cluster is True else cluster)
        if key[0] != "day":
            raise ValueError("a clustering key starts with the partition column 'day'")
        if "cell" in key:
            out = out.withColumn("cell", cell_of(F.col("latitude"), F.col("longitude")))
        ranges = range_count(
            out.count(), target_file_bytes, df.sparkSession.sparkContext.defaultParallelism
        )
        out = out.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    elif rebalance:
        out = out.hint("rebalance", "day")
    overwrite = "static" if days is None else "dynamic"
    writer = out.write.mode(mode).option("partitionOverwriteMode", overwrite)
    writer.partitionBy("day").parquet(path)


def range_count(rows: int, target_file_bytes: int = TARGET_FILE_BYTES, cores: int = 1) -> int:
    """Ranges of the target size; of a small input enough to keep ``cores`` busy, as long as
    each gets ``LEAST_ROWS``."""
    by_size = math.ceil(rows * BYTES_PER_ROW / target_file_bytes)
    return max(1, by_size, min(cores, rows // LEAST_ROWS))


def read_measurements(
    spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """The store's reports; with ``box`` (north, east, south, west; edges included) those in it.

    The box is tested exactly, and by ranges of cells as well where the store has them: these
    reach the scan, which then skips files and row groups of other places.
    """
    stored = spark.read.schema(MEASUREMENTS_STORE_SCHEMA).parquet(path)
    if box is not None:
        cell = F.col("cell")
        inside = in_box(F.col("latitude"), F.col("longitude"), *box)
        stored = stored.filter((cell.isNull() | cell_in_box(cell, *box)) & inside)
    date = F.coalesce("date", instant_text(F.col("ts")))
    return stored.withColumn("date", date).select(*TYPED_SCHEMA.fieldNames())


# ---- ingest store -------------------------------------------------------------------------


def store_rows(parsed: DataFrame) -> DataFrame:
    """Rows of an ingest store from ``parse_lines`` output: typed values for good rows, the
    raw line and the reason for bad ones, a ``status`` column and the ``day``."""
    status = F.when(F.col("reason").isNull(), F.lit(GOOD)).otherwise(F.lit(BAD))
    # Good rows carry no raw line, bad rows no typed values: nulls cost next to nothing.
    return parsed.select(
        *[F.when(status == GOOD, F.col(c)).alias(c) for c in STORED_COLUMNS],
        F.when(status == BAD, F.col("line")).alias("line"),
        F.col("reason"),
        status.alias("status"),
        F.col("day"),
    )


def _write_version(
    spark: SparkSession, parsed: DataFrame, dest: str, batch: str, rebalance: bool = False
) -> tuple[str, list[str]]:
    """A new version of ``batch``, not yet committed, and which of good and bad it has."""
    version = uuid.uuid4().hex[:12]
    path = version_path(dest, batch, version)
    rows = store_rows(parsed)
    if rebalance:
        rows = rows.hint("rebalance", "status", "day")
    writer = rows.write.partitionBy("status", "day")
    for key, value in BLOOM_OPTIONS.items():
        writer = writer.option(key, value)
    writer.parquet(path)
    return version, [s for s in (GOOD, BAD) if folder_exists(spark, f"{path}/status={s}")]


def ingest_csv_to_store(
    spark: SparkSession,
    src: str | list[str],
    dest: str,
    batch: str,
    rebalance: bool = False,
) -> None:
    """Parse CSV text once; write its good and bad rows side by side as landing batch ``batch``.

    ``batch`` names what was landed (a day's delivery, a file set). Ingesting a batch again
    replaces exactly the rows it had before, in one commit; nothing else in the store changes,
    even if its rows fall on days of other batches.

    ``rebalance`` as in :func:`write_measurements` (off: one pass, no shuffle, right for
    landing files that each cover a short time span).
    """
    _check_batch(batch)
    paths = [src] if isinstance(src, str) else list(src)
    # no filter downstream (status is a partition column): the pushdown barrier is not needed
    parsed = parse_lines(spark.read.text(paths), filter_barrier=False)
    version, has = _write_version(spark, parsed, dest, batch, rebalance)
    entry = _entry(version, has)
    commits.commit(spark, dest, lambda batches: {**batches, batch: entry})


def _entry(version: str, has: list[str], parser: int = PARSER_VERSION) -> dict:
    """A batch in a snapshot: the versions its good and its bad rows are in."""
    return {
        GOOD: [version] if GOOD in has else [],
        BAD: [version] if BAD in has else [],
        "parser": parser,
    }


def batch_rows(
    spark: SparkSession, dest: str, status: str, versions: Iterable[tuple[str, str]]
) -> DataFrame | None:
    """Stored rows of the given (batch, version)s, with these two columns; None for none."""
    paths = [f"{version_path(dest, b, v)}/status={status}" for b, v in versions]
    if not paths:
        return None
    reader = spark.read.schema(_BATCHES_SCHEMA).option("basePath", f"{dest.rstrip('/')}/batches")
    return reader.parquet(*paths)


def versions_of(snapshot: commits.Snapshot, status: str) -> list[tuple[str, str]]:
    return [(b, v) for b, e in sorted(snapshot.batches.items()) for v in e[status]]


def stream_rows(spark: SparkSession, dest: str) -> list[DataFrame]:
    """Stored rows of every stream, each read through its sink log, so that the files of an
    unfinished micro-batch are not seen."""
    root = dest.rstrip("/")
    reader = spark.read.schema(INGEST_STORE_SCHEMA)
    return [reader.parquet(stream_path(root, s)) for s in folders(spark, f"{root}/streams")]


def typed(rows: DataFrame) -> DataFrame:
    """Stored good rows as measurements."""
    return rows.withColumn("date", instant_text(F.col("ts"))).select(*TYPED_SCHEMA.fieldNames())


def read_ingested(spark: SparkSession, dest: str) -> Ingest:
    """(good, bad) of all streams and of the batches as of the last commit; each side reads only
    its own partitions."""
    snapshot = commits.current(spark, dest)
    streams = stream_rows(spark, dest)
    if not snapshot.number and not streams:
        raise FileNotFoundError(f"no ingest store at {dest}")

    def side(status: str) -> DataFrame:
        parts = [s.filter(F.col("status") == status) for s in streams]
        rows = batch_rows(spark, dest, status, versions_of(snapshot, status))
        if rows is not None:
            parts.append(rows.select(*INGEST_STORE_SCHEMA.fieldNames()))
        if not parts:
            return spark.createDataFrame([], INGEST_STORE_SCHEMA)
        return reduce(DataFrame.unionByName, parts)

    return Ingest(typed(side(GOOD)), side(BAD).select(*BAD_COLUMNS))


def replay_bad(
    spark: SparkSession,
    dest: str,
    parse: Callable[[DataFrame], DataFrame] = parse_lines,
    parser: int = PARSER_VERSION,
) -> list[str]:
    """Parse the bad lines of batches that an older parser read again; the batches' ids.

    ``parse`` takes a DataFrame with the raw lines as ``value`` and returns what ``parse_lines``
    does. Only the quarantined lines are read and written: what is good now joins the batch's good
    rows in a version of its own, and the version of the remaining bad lines takes the old one's
    place, both in one commit per batch. A batch that was ingested anew meanwhile is left alone.
    """
    done = []
    for batch, entry in sorted(commits.current(spark, dest).batches.items()):
        if entry["parser"] >= parser or not entry[BAD]:
            continue
        rows = batch_rows(spark, dest, BAD, [(batch, v) for v in entry[BAD]])
        parsed = parse(rows.select(F.col("line").alias("value")))
        version, has = _write_version(spark, parsed, dest, batch)
        new = _entry(version, has, parser)
        new[GOOD] = [*entry[GOOD], *new[GOOD]]

        def change(batches: dict[str, dict], batch=batch, entry=entry, new=new) -> dict[str, dict]:
            same = all(batches.get(batch, {}).get(s) == entry[s] for s in (GOOD, BAD))
            kept = {k: v for k, v in batches.get(batch, {}).items() if k not in new}
            return {**batches, batch: {**kept, **new}} if same else batches

        after = commits.commit(spark, dest, change)
        if version in after.batches[batch][GOOD] + after.batches[batch][BAD]:
            done.append(batch)
    return done


# ---- landing folders ----------------------------------------------------------------------


def landed_files(spark: SparkSession, dest: str) -> DataFrame:
    """``path, length, modified, batch, version`` of the files that batches were made from."""
    entries = commits.current(spark, dest).batches
    paths = [
        version_path(dest, b, e["landed"], "landed") for b, e in sorted(entries.items()) if "landed" in e
    ]
    if not paths:
        return spark.createDataFrame([], LANDED_SCHEMA)
    reader = spark.read.schema(LANDED_SCHEMA).option("basePath", f"{dest.rstrip('/')}/landed")
    return reader.parquet(*paths)


def ingest_new_files(
    spark: SparkSession, src_dir: str, dest: str, batch: str, rebalance: bool = False
) -> int:
    """Ingest the files below ``src_dir`` that no batch of the store was made from yet, as
    landing batch ``batch``; their number.

    What has landed is a table of (path, length, time), written with the batch and committed
    with it, so a file is neither parsed twice nor forgotten, wherever a run stops. Landed files
    are not to change: one that is there again with another length or time is an error, and so
    is a batch id that is taken. Without new files nothing is written.
    """
    if batch in commits.current(spark, dest).batches:
        raise ValueError(f"the store has a batch {batch!r}; new files need a new one")
    listed = (  # only the listing: the content column is not read
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(src_dir)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    known = landed_files(spark, dest).select(
        "path", F.col("length").alias("had_length"), F.col("modified").alias("had_modified")
    )
    both = listed.join(known, "path", "left")
    changed = both.filter(
        F.col("had_length").isNotNull()
        & ((F.col("length") != F.col("had_length")) | (F.col("modified") != F.col("had_modified")))
    ).first()
    if changed is not None:
        raise ValueError(f"{changed['path']} was ingested and has changed since")
    new = both.filter(F.col("had_length").isNull()).select("path", "length", "modified")
    marker = uuid.uuid4().hex[:12]
    landed = version_path(dest, batch, marker, "landed")
    new.write.parquet(landed)
    # the list that is committed is the list that is read
    paths = [r["path"] for r in spark.read.parquet(landed).select("path").toLocalIterator()]
    if not paths:
        commits.remove(spark, landed)
        return 0
    parsed = parse_lines(spark.read.text(paths), filter_barrier=False)
    version, has = _write_version(spark, parsed, dest, batch, rebalance)
    entry = {**_entry(version, has), "landed": marker}

    def change(batches: dict[str, dict]) -> dict[str, dict]:
        if batch in batches:
            raise ValueError(f"another run has committed batch {batch!r}")
        return {**batches, batch: entry}

    commits.commit(spark, dest, change)
    return len(paths)


def vacuum(spark: SparkSession, dest: str, keep: int = 10) -> int:
    """Remove versions, states and lists that none of the last ``keep`` commits names; how many.

    Plans made before those commits can't be run any more, and a write that is not committed yet
    is removed as well: run it when nothing is being ingested.
    """
    stay = commits.forget(spark, dest, keep)
    named: set[str] = set()
    for snapshot in stay:
        for entry in snapshot.batches.values():
            named |= {*entry[GOOD], *entry[BAD], entry.get("landed", "")}
            named |= {w for writes in entry.get("states", {}).values() for w in writes.values() if w}
    removed = 0
    root = dest.rstrip("/")
    for top in ("batches", "landed"):
        for b in folders(spark, f"{root}/{top}"):
            for v in folders(spark, f"{root}/{top}/{b}"):
                if v.removeprefix("version=") not in named:
                    commits.remove(spark, f"{root}/{top}/{b}/{v}")
                    removed += 1
    for kind in folders(spark, f"{root}/states"):
        for write in folders(spark, f"{root}/states/{kind}"):
            if write not in named:
                commits.remove(spark, f"{root}/states/{kind}/{write}")
                removed += 1
    return removed
