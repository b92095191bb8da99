"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import remove_at_exit, shared_dir

# ASCII white space: space and U+0009..U+000D. Java writes the vertical tab as \x0B.
WS_RUN = r"[ \t\n\x0B\f\r]+"
NOT_WS = r"[^ \t\n\x0B\f\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint directory and read it back.

    Used where a result is needed by several branches, or where row numbers given inside
    tasks have to stay fixed: the written files survive lost executors, and later stages do
    not recompute what led to them. They are removed when the driver's Python ends.
    """
    path = shared_dir(df.sparkSession, name)
    remove_at_exit(df.sparkSession, path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, as a lambda variable.

    Inside a higher-order function a column expression would be evaluated again for every
    element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_RUN), "")


def text_slices(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts with some ``chars`` characters, one text at least."""
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= chars or i + 1 == len(texts):
            yield at, i + 1 - at
            at, held = i + 1, 0


def batch_slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with some ``size`` bytes of ``column``, one row at least.

    Only a slice's texts become Python strings at once, however long the batch's texts are.
    """
    length = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(length.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        held = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, held + size, side="right")))
        yield batch.slice(at, to - at)
        at = to
