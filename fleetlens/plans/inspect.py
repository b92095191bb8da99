"""Read a DataFrame's physical plan through the public ``explain`` API (used by tests and
the bench to assert plan shapes: scans, exchanges, pushed filters, no Python UDFs)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_string(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def scan_count(df: DataFrame) -> int:
    """Number of file scans in the physical plan (reused exchanges are not rescans)."""
    return len(re.findall(r"^\(\d+\) Scan ", plan_string(df), flags=re.MULTILINE))


def exchange_count(df: DataFrame) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", plan_string(df), flags=re.MULTILINE))


def uses_python_udf(df: DataFrame) -> bool:
    text = plan_string(df, "extended")
    return any(tag in text for tag in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))
