"""Ways to obtain a measurements DataFrame (typed columns + ``ts`` + ``day``)."""

from fleetlens.sources.csv_ingest import Ingest, parse_lines, read_measurements_csv, split_parsed
from fleetlens.sources.csv_reader import read_measurements_csv_reader
from fleetlens.sources.events import measurements_from_events
from fleetlens.sources.frame import measurements_from_frame
from fleetlens.sources.states import read_states, refresh_states
from fleetlens.sources.store import (
    ingest_csv_to_store,
    ingest_new_files,
    landed_files,
    read_ingested,
    read_measurements,
    replay_bad,
    vacuum,
    write_measurements,
)

__all__ = [
    "Ingest",
    "ingest_csv_to_store",
    "ingest_new_files",
    "landed_files",
    "measurements_from_events",
    "measurements_from_frame",
    "parse_lines",
    "read_ingested",
    "read_measurements",
    "read_measurements_csv",
    "read_measurements_csv_reader",
    "read_states",
    "refresh_states",
    "replay_bad",
    "split_parsed",
    "vacuum",
    "write_measurements",
]
