"""Input checks and filters shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.schema import NO_STOP


def require_columns(m: DataFrame, *names: str) -> None:
    """Fail early, with a pointer to the sources, when the input lacks a column."""
    missing = [n for n in names if n not in m.columns]
    if missing:
        raise ValueError(
            f"input lacks {missing}; read it through fleetlens.sources (for a DataFrame of "
            "the ten report fields use sources.measurements_from_frame)"
        )


def without_no_stop(m: DataFrame) -> DataFrame:
    """Reports near some stop (a NULL stop is not the sentinel and stays)."""
    return m.filter(~F.col("closerStopID").eqNullSafe(NO_STOP))
