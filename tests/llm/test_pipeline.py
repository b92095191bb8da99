"""The pipeline, stage by stage, against brute force on what each stage was given."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as c
import pytest
from conftest import SF_SMALL
from differential import duck
from edge import edge_docs, empty_docs
from plain_knn import plain_scores
from plain_spans import PII, base_spans
from test_packing import check_packed
from test_simhash import plain_components, plain_fingerprint

from fleetlens.llm import packing, pii_weak, quality_rules
from fleetlens.llm.common import table


def as_rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF_SMALL, "documents").cache()
    seen = [docs]
    for _, f in c.STAGES:
        seen.append(f(spark, seen[-1], SF_SMALL).cache())
    return seen


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_toxicity(spark, stages):
    rows = as_rows(stages[0])
    labels = [(r.doc_id, r.toxic) for r in table(spark, SF_SMALL, "labels").collect()]
    scores = plain_scores([(r[0], r[1]) for r in rows], labels)
    kept = [r for r, (_, p, _) in zip(rows, scores, strict=True) if p < 0.5]
    assert 0 < len(kept) < len(rows)
    assert Counter(as_rows(stages[1])) == Counter(kept)


def test_quality_rules(stages):
    con = duck(SF_SMALL)
    kept = {r[0] for r in con.sql(quality_rules.ORACLE).fetchall() if r[7]}
    assert Counter(as_rows(stages[2])) == Counter(r for r in as_rows(stages[1]) if r[0] in kept)


def test_near_copies(stages):
    rows = as_rows(stages[2])
    ids = [r[0] for r in rows]
    comp = plain_components(ids, [plain_fingerprint(r[1]) for r in rows])
    expected = [r for r, k in zip(rows, comp, strict=True) if r[0] == k]
    assert Counter(as_rows(stages[3])) == Counter(expected)


def test_personal_data(stages):
    found = {r.doc_id: [tuple(x) for x in r.found] for r in pii_weak.find(stages[3]).collect()}

    def masked(doc_id, text):
        spans = found[doc_id]
        assert [x for x in spans if x[2] in pii_weak.BASE] == base_spans(text, PII)
        out, at = [], 0
        for a, _, kind, b in sorted(spans, key=lambda x: (x[0], -x[3])):
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    expected = [(r[0], masked(r[0], r[1]), *r[2:]) for r in as_rows(stages[3])]
    assert Counter(as_rows(stages[4])) == Counter(expected)


def test_packing(stages):
    rows = stages[5].collect()
    check_packed(rows, [(r[0], r[1]) for r in as_rows(stages[4])], packing.CAPACITY)


def test_run_is_the_stages_in_order(spark, stages):
    got = c.run(spark, SF_SMALL).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(as_rows(got)) == Counter(
        as_rows(stages[5].select("doc_id", "piece", "start", "length", "ids_crc32"))
    )


@pytest.mark.parametrize("make", [edge_docs, empty_docs])
def test_stages_take_edge_rows(spark, make):
    docs = make(spark)
    for name, f in c.STAGES[:-1]:
        out = f(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        out.collect()
    c.STAGES[-1][1](spark, docs, SF_SMALL).collect()
