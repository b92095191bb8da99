"""Query registry (name -> Spark plan, name -> DuckDB SQL) and plan inspection helpers."""

from fleetlens.plans.inspect import plan_string, scan_count, uses_python_udf
from fleetlens.plans.registry import MEASUREMENTS_CTE, ORACLE_SQL, QUERIES

__all__ = [
    "MEASUREMENTS_CTE",
    "ORACLE_SQL",
    "QUERIES",
    "plan_string",
    "scan_count",
    "uses_python_udf",
]
