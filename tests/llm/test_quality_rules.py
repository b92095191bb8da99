"""op1 against DuckDB, the ledger against brute force, and the edge rows."""

from __future__ import annotations

import pytest
from conftest import SF_ORACLE, SF_SMALL
from differential import compare, duck

from edge import edge_docs, empty_docs
from fleetlens.llm import quality_rules as q
from fleetlens.llm.common import table


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query_matches_duckdb(spark, sf):
    ok, msg = compare(spark, duck(sf), sf, "op1", q.query, q.ORACLE)
    assert ok, msg


def test_ablation_equals_reapplying_without_the_rule(spark):
    led = q.ledger(table(spark, SF_SMALL, "documents"))
    policy = q.POLICIES["v2"]
    bits = [r.fail_bits for r in led.select("fail_bits").collect()]
    m = q.mask(policy)
    got = {r.rule: tuple(r)[1:] for r in q.ablate(led, policy).collect()}
    for r in q.RULES:
        b = 1 << r.bit
        assert got[r.name] == (
            sum(bool(x & b) for x in bits),
            sum((x & m) == b for x in bits),
            sum(not (x & m & ~b) for x in bits),
        )


def test_policies_differ_only_by_mask(spark):
    led = q.ledger(table(spark, SF_SMALL, "documents"))
    base = q.apply_policy(led, q.POLICIES["v1"]).filter("kept").count()
    current = q.apply_policy(led, q.POLICIES["v2"]).filter("kept").count()
    assert current <= base


def test_edge_rows(spark):
    rows = q.ledger(edge_docs(spark)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == 11
    assert by[2][0].n_words == by[3][0].n_words == by[4][0].n_words == 0
    assert by[7][0] == by[7][1]
    assert by[6][0].n_repeat_words == 0 and by[5][0].n_words == 40_000
    assert by[1][0].n_repeat_words == 80
    kept = q.filter_documents(edge_docs(spark), q.POLICIES["v2"])
    assert kept.columns == edge_docs(spark).columns
    assert [r.doc_id for r in kept.collect()] == [5]
    assert q.ledger(empty_docs(spark)).count() == 0
    assert q.filter_documents(empty_docs(spark), q.POLICIES["v2"]).count() == 0
    assert {r.n_failed for r in q.ablate(q.ledger(empty_docs(spark)), q.POLICIES["v2"]).collect()} == set()


def test_verdicts_and_ablations_come_from_one_stored_ledger(spark, monkeypatch):
    read = []
    measured = q._measures
    monkeypatch.setattr(q, "_measures", lambda text: read.append(1) or measured(text))
    rows = q.judged(edge_docs(spark), q.POLICIES["v1"], q.POLICIES["v2"]).collect()
    assert len(rows) == 11 and len(read) == 1  # the texts' expressions are built once
    names = {1 << r.bit: r.name for r in q.RULES}
    for r in rows:
        assert r.kept == (r.fail_bits == 0) and r.base_failed == bool(r.fail_bits & 3)
        assert r.sole_rule == names.get(r.fail_bits)
        alone = sum(x.fail_bits == r.fail_bits for x in rows)
        assert r.n_sole == (alone if r.sole_rule else None)
    assert q.judged(empty_docs(spark), q.POLICIES["v1"], q.POLICIES["v2"]).count() == 0
