"""fleetlens: batch analytics over bus position reports, written as Spark DataFrame plans.

Every operator takes a *measurements* DataFrame (see ``fleetlens.schema``) and returns a
DataFrame; nothing is collected to the driver. Sources turn raw CSV text, the parquet store or
the driver's ``events`` table into that shape.
"""

from fleetlens.schema import MEASUREMENT_COLUMNS, MEASUREMENTS_SCHEMA
from fleetlens.session import get_session, shared_dir

__all__ = ["MEASUREMENT_COLUMNS", "MEASUREMENTS_SCHEMA", "get_session", "shared_dir"]
