"""The entry's queries that have no SQL."""

from __future__ import annotations

import differential


def test_queries_without_sql_are_named_and_skipped(spark, capsys, monkeypatch):
    monkeypatch.setattr("fleetlens.session.get_session", lambda *a, **k: spark)
    argv = ["differential.py", "/root/testdata/sf0.001", "op2_sampled_pieces", "op10_simhash"]
    assert differential.main(argv) == 0
    out = capsys.readouterr().out
    assert "op2_sampled_pieces: no SQL" in out and "op10_simhash: no SQL" in out
