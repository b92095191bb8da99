"""op7: base spans against plain Python, the estimation, masking and the edge rows."""

from __future__ import annotations

import random

import numpy as np
from conftest import SF_ORACLE
from edge import edge_docs, empty_docs
from plain_spans import PII, base_spans, digest

from fleetlens.llm import pii_weak as p
from fleetlens.llm.common import table

HARD = [
    "a@b.c_d@e.f x@y a@@b.c a@b..c 'q%+w.@x-y.z.z'",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3 999999999999999999999999.1.1.1 1..2.3.4",
    "4111 1111 1111 1111 4111111111111111-4111 1 2 3 5500-0000-0000-0004 00000000000000000000",
    "+1 (132) 555-1352 190.137.223.2 +12 +1-234 567 89 +4930 123456789012345 ++1 555 555 5555)",
    "\x01 a@b.co \x01\x02 +1 555 555 5555 \U0001f600é 10.0.0.1 \x01",
    "9" * 20000 + " " + "a" * 20000 + "@x" + ".b" * 9000 + " " + "1 " * 9000,
    "+1 " * 3000 + "1.1.1.1 " * 700,
    "",
]


def fuzz(seed, n=300):
    rng = random.Random(seed)
    alphabet = "aZ09.. --@@++()_% \n\x01é\U0001f600" + "12345" * 2
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 90))) for _ in range(n)]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans_match_plain_python(spark):
    texts = HARD + fuzz(1)
    rows = {r.doc_id: r.found for r in p.find(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        got = [tuple(s) for s in rows[i] if s.kind in p.BASE]
        assert sorted(got) == base_spans(t, PII), i


def test_query_digest(spark):
    rows = {r.doc_id: r for r in p.query(spark, SF_ORACLE).collect()}
    docs = table(spark, SF_ORACLE, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        counts, sha, spans = digest(d.text, PII)
        r = rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == sha
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))
        if not any(c.isdigit() for c in d.text or ""):
            assert not set(r.spans.split(",")) - set(spans.split(","))


def test_estimation_finds_the_good_labelers():
    rng = np.random.default_rng(2)
    counts = {}
    for _ in range(6000):
        truth = rng.random() < 0.4
        votes = []
        for accuracy in (0.95, 0.9, 0.85, 0.8, 0.5, 0.6):
            right = rng.random() < accuracy
            votes.append(1 if truth == right else -1)
        key = ("account", 2, tuple(votes), truth)
        counts[key] = counts.get(key, 0) + 1
    merged = {}
    for (k, s, v, _), n in counts.items():
        merged[(k, s, v)] = merged.get((k, s, v), 0) + n
    model = p.fit([(*k, n) for k, n in merged.items()])
    good, useless = model.reliability["regex"], model.reliability["company"]
    assert good[1][2] > 0.9 and good[0][0] > 0.9
    assert abs(useless[1][2] - useless[0][2]) < 0.1
    hits = total = 0
    for (k, s, v, truth), n in counts.items():
        x = model.kind[k] + model.size[s] + sum(model.vote[l][u + 1] for l, u in zip(p.LABELERS, v))
        hits += n * ((x > 0) == truth)
        total += n
    assert hits / total > 0.93


def test_masking(spark):
    text = "mail a.b@c.com or \U0001f600 +1 (555) 555-5555, ip 10.0.0.1 card 4111 1111 1111 1111!"
    docs = docs_of(spark, [text, "nothing here", None, ""])
    got = {r.doc_id: r.text for r in p.mask(docs).collect()}
    assert got == {
        0: "mail [EMAIL] or \U0001f600 [PHONE], ip [IP] card [CARD]!",
        1: "nothing here",
        2: None,
        3: "",
    }


def test_edge_rows(spark):
    rows = p.find(edge_docs(spark)).collect()
    assert len(rows) == 11
    nine = next(r for r in rows if r.doc_id == 9)
    assert [s.kind for s in nine.found] == ["card", "email"]
    masked = p.mask(edge_docs(spark))
    assert masked.columns == edge_docs(spark).columns and masked.count() == 11
    assert p.find(empty_docs(spark)).count() == 0
    assert p.mask(empty_docs(spark)).count() == 0
    assert p.fit([]).kind["account"] < 0


def test_digits_that_all_stand_alone(spark):
    texts = [" ".join("4" + "1" * 15), "-".join("4" + "1" * 15), "x 5 5 0 0-0 0 0 0-0 0 0 0 0 0 0 4."]
    rows = {r.doc_id: r.found for r in p.find(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in rows[i] if s.kind in p.BASE] == base_spans(t, PII)
        assert [s.kind for s in rows[i]] == ["card"]
    masked = {r.doc_id: r.text for r in p.mask(docs_of(spark, texts)).collect()}
    assert masked == {0: "[CARD]", 1: "[CARD]", 2: "x [CARD]."}
    account = docs_of(spark, [" ".join("4" + "1" * 11)]).select(p.candidates("text").alias("c"))
    assert [s.kind for s in account.first().c] == ["account"]
