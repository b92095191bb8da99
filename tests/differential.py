"""Spark vs DuckDB differential check for the query registry.

Usable from pytest and from the command line::

    python tests/differential.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark simple type -> DuckDB type name, for the types the registry produces.
SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "array<int>": "INTEGER[]",
}


def _norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, query_fn, sql: str) -> tuple[bool, str]:
    sdf = query_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    d_types = dict(zip(d_cols, (str(t) for t in rel.types)))
    for f in sdf.schema:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString())
        if want != d_types[f.name]:
            return False, f"type of {f.name}: spark={f.dataType.simpleString()} duckdb={d_types[f.name]}"
    # align DuckDB's column order to Spark's
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in idx) for r in d_rows]
    a, b = _rows(s_rows), _rows(d_rows)
    if len(a) != len(b):
        return False, f"row count differs: spark={len(a)} duckdb={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ (first: {diff})"
    return True, f"{len(a)} rows"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from fleetlens.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session(
        "local[8]", shuffle_partitions=8, conf={"spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(q):
        if name not in o:
            print(f"-- {name}: no SQL, not compared", flush=True)
            continue
        ok, msg = compare(spark, con, sf_dir, name, q[name], o[name])
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
