"""The registered queries and their SQL."""

from __future__ import annotations

import __spark_entry__ as e


def test_every_oracle_is_sql_of_a_query():
    for name, sql in e.oracle_sql().items():
        assert name in e.queries()
        assert isinstance(sql, str), name
