"""The CSV reader with an explicit schema: the source the reference's DataFrame jobs use.

Lenient by construction: a cell that does not parse becomes NULL (a date in any form but
``yyyy-MM-dd HH:mm:ss`` has no ``ts`` and matches no time predicate), a short row is padded with
NULLs, surplus fields are dropped, and nothing is reported. The CSV parser converts only the
columns a query reads, so which rows look malformed depends on the projection (SURVEY D17).
That pruning is also why it is faster than the strict ingest. Use it for input that is already
known to be clean (for example text written by a validated job); use
:func:`fleetlens.sources.read_measurements_csv` when bad rows must be found and kept aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.timefmt import strict_instant
from fleetlens.schema import MEASUREMENTS_SCHEMA, TYPED_SCHEMA

# The reader options of the input format (no header, comma, quoting off).
CSV_OPTIONS = {"sep": ",", "quote": "", "header": "false", "mode": "PERMISSIVE"}


def read_measurements_csv_reader(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed measurements (+ ``ts``, ``day``) through ``spark.read.csv`` with the schema."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.schema(MEASUREMENTS_SCHEMA).options(**CSV_OPTIONS).csv(paths)
    ts = strict_instant(F.col("date"))
    return raw.select(
        *MEASUREMENTS_SCHEMA.fieldNames(), ts.alias("ts"), F.to_date(ts).alias("day")
    ).select(*TYPED_SCHEMA.fieldNames())
