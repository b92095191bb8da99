"""Partial states of a store's batches, kept beside their rows.

A state belongs to one version of one batch. A version's rows never change, so its states stay
right for ever; when a batch is replaced, its new version has none yet and the old one's are no
longer named by the snapshot: they are dropped with the version and rebuilt by the next
``refresh_states``, which reads the rows of versions without states only. ``read_states`` gives
the states of everything that the store holds, computing what is missing (streams, versions that
have not been refreshed) on the fly, so its answer is always that of the last commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.history import STATES, make
from fleetlens.sources import commits
from fleetlens.sources.store import GOOD, batch_rows, stream_rows, typed, versions_of


def _schema(kind: str) -> str:
    return f"{STATES[kind].schema}, batch string, version string"


def _known(snapshot: commits.Snapshot, kind: str, batch: str) -> dict[str, str | None]:
    """By version of the batch the write that its state is in (None: it has no reports for one)."""
    return snapshot.batches[batch].get("states", {}).get(kind, {})


def _missing(snapshot: commits.Snapshot, kind: str) -> list[tuple[str, str]]:
    return [(b, v) for b, v in versions_of(snapshot, GOOD) if v not in _known(snapshot, kind, b)]


def refresh_states(spark: SparkSession, dest: str, kinds: Iterable[str] = tuple(STATES)) -> int:
    """Make the states that versions lack, in one job per kind, and commit them; how many."""
    made = 0
    for kind in kinds:
        missing = _missing(commits.current(spark, dest), kind)
        if not missing:
            continue
        rows = batch_rows(spark, dest, GOOD, missing)
        write = uuid.uuid4().hex[:12]
        path = f"{dest.rstrip('/')}/states/{kind}/{write}"
        # a version's state in few files: its rows meet by (batch, version) after the aggregate
        states = make(kind, rows, "batch", "version").hint("rebalance", "batch", "version")
        states.write.partitionBy("batch", "version").parquet(path)
        found = {
            (b.removeprefix("batch="), v.removeprefix("version="))
            for b in commits.folders(spark, path)
            for v in commits.folders(spark, f"{path}/{b}")
        }

        def change(batches: dict[str, dict]) -> dict[str, dict]:
            for b, v in missing:
                entry = batches.get(b)
                if entry and v in entry[GOOD]:  # else it was replaced meanwhile
                    own = entry.setdefault("states", {}).setdefault(kind, {})
                    own[v] = write if (b, v) in found else None
                    for old in set(own) - set(entry[GOOD]):
                        del own[old]
            return batches

        commits.commit(spark, dest, change)
        made += len(missing)
    return made


def read_states(spark: SparkSession, dest: str, kind: str) -> DataFrame:
    """States of ``kind`` that together cover every good row of the store, to be merged."""
    snapshot = commits.current(spark, dest)
    root = f"{dest.rstrip('/')}/states/{kind}"
    columns = [c.split()[0] for c in STATES[kind].schema.split(", ")]
    by_write: dict[str, list[str]] = {}
    for b, v in versions_of(snapshot, GOOD):
        if write := _known(snapshot, kind, b).get(v):
            by_write.setdefault(write, []).append(f"{root}/{write}/batch={b}/version={v}")
    parts = [
        spark.read.schema(_schema(kind)).option("basePath", f"{root}/{write}").parquet(*paths)
        for write, paths in sorted(by_write.items())
    ]
    raw = [typed(s.filter(F.col("status") == GOOD)) for s in stream_rows(spark, dest)]
    rows = batch_rows(spark, dest, GOOD, _missing(snapshot, kind))
    raw += [typed(rows)] if rows is not None else []
    parts += [make(kind, m) for m in raw]
    if not parts:
        return spark.createDataFrame([], STATES[kind].schema)
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
