"""op4 against DuckDB and plain Python."""

from __future__ import annotations

import random

import pytest
from conftest import SF_ORACLE, SF_SMALL
from differential import compare, duck
from edge import edge_docs, empty_docs
from plain_spans import SECRETS, base_spans, digest
from pyspark.sql import functions as F

from fleetlens.llm import secrets_owners as s
from fleetlens.llm.common import table

HARD = [
    "password=token: abcdefgh secret:token=abcdef PASSWD = 'abc' api_key:\"A1b2C3/=+._-x\" apikey=123456",
    "token token=ab token=abcdefgh TOKEN  :  ''x password\"=\"longenough\" passwordsecret=abcdef7",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " xAKIAAKIA" + "1" * 14 + " akia" + "A" * 20,
    "0123456789abcdef01234567 0123456789abcdef0123456 " + "f" * 5000 + "g" + "A" * 24,
    "\x01token=\x01abcdefg \U0001f600é secret=abcdefg \x02 " + "\x01" * 5,
    "ſecret=abcdefgh toKen=abcdefgh",
    "token=" * 3000 + " " + "api_key " * 2000 + " " * 5000 + "secret" + " " * 5000,
    "",
]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query_matches_duckdb(spark, sf):
    ok, msg = compare(spark, duck(sf), sf, "op4", s.query, s.ORACLE)
    assert ok, msg


def test_query_matches_plain_python(spark):
    rows = {r.doc_id: r for r in s.query(spark, SF_ORACLE).collect()}
    for d in table(spark, SF_ORACLE, "documents").collect():
        counts, sha, spans = digest(d.text, SECRETS)
        r = rows[d.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == counts and r.base_sha256 == sha
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))


def test_base_spans_on_hard_texts(spark):
    rng = random.Random(4)
    words = ["token", "=", ":", " ", "'", '"', "secret", "api_key", "abc", "AKIA", "0f" * 9, "é"]
    fuzz = ["".join(rng.choice(words) for _ in range(rng.randrange(3, 25))) for _ in range(300)]
    texts = HARD + fuzz
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    rows = {r.doc_id: r.found for r in s.find(docs, F.col("source"), F.col("lang")).collect()}
    for i, t in enumerate(texts):
        got = [tuple(x) for x in rows[i] if x.kind in s.BASE]
        assert got == base_spans(t, SECRETS), i


def test_ownership_parts_examples_from_live(spark):
    copied, own = "ghp_" + "aB3dE6gH9" * 4, "ghp_" + "Zy8Xw5Vu2" * 4
    rows = [(i, f"see {copied} here", "en", f"s{i % 4}") for i in range(12)]
    rows += [(100 + i, f"my {own} {copied}", "en", "s9") for i in range(5)]
    got = {r.doc_id: r for r in s.find(docs_of(spark, rows), F.col("source"), F.col("lang")).collect()}
    assert all(got[i].found == [] and got[i].n_example == 1 for i in range(12))
    for i in range(100, 105):
        assert [x.kind for x in got[i].found] == ["vendor"] and got[i].n_live == 1
        assert got[i].found[0].start == 3
    counts = {
        r.hash: (r.n_owners, r.n_repos)
        for r in s.ownership(
            spark.createDataFrame(
                [("h", "a", "1"), ("h", "a", "1"), ("h", "a", "2"), ("h", None, "3"), ("k", "a", None)],
                "hash string, owner string, repo string",
            )
        ).collect()
    }
    assert counts == {"h": (2, 3), "k": (1, 1)}


def test_what_one_owner_spreads_over_repositories_is_an_example(spark):
    spread, own = "ghp_" + "aB3dE6gH9" * 4, "ghp_" + "Zy8Xw5Vu2" * 4
    rows = [(i, f"see {spread} here", f"r{i}", "s1") for i in range(s.MAX_REPOS + 1)]
    rows += [(100 + i, f"my {own}", f"r{i}", "s1") for i in range(s.MAX_REPOS)]
    got = {r.doc_id: r for r in s.find(docs_of(spark, rows), F.col("source"), F.col("lang")).collect()}
    assert all(got[i].found == [] and got[i].n_example == 1 for i in range(s.MAX_REPOS + 1))
    assert {(got[i].n_owners, got[i].n_repos) for i in range(s.MAX_REPOS + 1)} == {(1, s.MAX_REPOS + 1)}
    assert all(got[100 + i].n_live == 1 and got[100 + i].n_repos == s.MAX_REPOS for i in range(s.MAX_REPOS))


def test_edge_rows(spark):
    assert s.find(edge_docs(spark), F.col("source"), F.col("lang")).count() == 11
    assert s.find(empty_docs(spark), F.col("source"), F.col("lang")).count() == 0
