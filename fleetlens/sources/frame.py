"""Bring a DataFrame that already has the ten report fields into the measurements shape.

For callers who read the data their own way (for example with the CSV reader and a 32-bit
float schema): columns are cast to the fleetlens types and ``ts``/``day`` are derived from
``date``. A ``date`` that is not a ``yyyy-MM-dd HH:mm:ss`` instant gives NULL ``ts``/``day``,
and such rows match no time predicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.timefmt import strict_instant
from fleetlens.schema import MEASUREMENT_COLUMNS, MEASUREMENTS_SCHEMA, TYPED_SCHEMA


def measurements_from_frame(df: DataFrame) -> DataFrame:
    missing = [c for c in MEASUREMENT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing report fields: {missing}")
    source_types = {f.name: f.dataType for f in df.schema.fields}
    typed = []
    for f in MEASUREMENTS_SCHEMA.fields:
        col = F.col(f.name)
        if isinstance(source_types[f.name], T.FloatType):
            # Widen a 32-bit coordinate through its shortest decimal text: 53.35f becomes
            # 53.35, not 53.349998474121094. Values with more digits than a float holds (the
            # 8-digit box corners) are already lost; read the source as DOUBLE to keep them.
            col = col.cast("string")
        typed.append(col.cast(f.dataType).alias(f.name))
    ts = strict_instant(F.col("date").cast("string"))
    return df.select(*typed, ts.alias("ts"), F.to_date(ts).alias("day")).select(
        *TYPED_SCHEMA.fieldNames()
    )
