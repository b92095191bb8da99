"""op8 against plain Python over the ordered documents."""

from __future__ import annotations

import hashlib

import pytest
from conftest import SF_ORACLE, SF_SMALL
from edge import ROWS, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import fingerprint_cth as f
from fleetlens.llm.common import table


def plain_levels(data):
    """Trigger positions by definition, one byte at a time."""
    out = []
    for i in range(len(data)):
        h = 0
        for k in range(f.WINDOW):
            byte = data[i - k] if i - k >= 0 else 0
            h += (byte + 1) * pow(f.FACTOR, k, 1 << 32)
        h &= 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x85EBCA6B & 0xFFFFFFFF
        h ^= h >> 13
        zeros = (h & -h).bit_length() - 1 if h else 32
        if zeros >= 2:
            out.append((i + 1, zeros - 2))
    return out


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + 1 if x == y else 0)
    return row[-1]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=300))
def test_triggers_by_definition(text):
    data = text.encode("utf-8", "surrogatepass")
    places, levels = f._levels(data)
    assert list(zip(places.tolist(), levels.tolist(), strict=True)) == plain_levels(data)


def test_chunks_do_not_show(monkeypatch):
    text = "some words of a text, " * 200 + "é" * 50
    whole = f.fingerprint(text)
    monkeypatch.setattr(f, "CHUNK", 97)
    assert f.fingerprint(text) == whole


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=70), st.lists(st.sampled_from("abc"), max_size=70))
def test_edit_distance(a, b):
    assert f._common(a, b) == plain_lcs(a, b)


def test_signatures_are_bounded_and_cover_the_text():
    for text in ["", "x", "ab" * 50_000, "word " * 30_000, "".join(map(chr, range(32, 9000)))]:
        size, one, two = f.fingerprint(text).split(":")
        assert f.PIECE_CHARS <= len(one) <= f.PIECE_CHARS * f.PIECES
        assert f.PIECE_CHARS <= len(two) <= len(one)
        assert f.fingerprint(text + "!") != f.fingerprint(text)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        q = len(text) // 4
        new = text[: len(text) - q] + nxt[:q]
        out[doc_id] = (
            len(text),
            hashlib.sha256(new.encode()).hexdigest(),
            f.fingerprint(text),
            f.fingerprint(new),
            f.likeness(f.fingerprint(text), f.fingerprint(new)),
            f.likeness(f.fingerprint(text), f.fingerprint(nxt)),
        )
    return out


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query(spark, sf):
    rows = f.query(spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert {r[0]: tuple(r)[1:] for r in rows} == expected(docs) and len(rows) == len(docs)
    edited = sorted(r.near_edited for r in rows)
    following = sorted(r.near_next for r in rows)
    assert edited[len(rows) // 20] > 0.5 > following[len(rows) * 19 // 20]


def test_edge_rows(spark):
    rows = f.compare_with_next(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows if r.doc_id not in (None, 7)}
    assert by[2].n_chars == by[3].n_chars == 0
    assert by[2].fingerprint == by[3].fingerprint and by[2].near_next == 1.0
    assert by[6].near_next == 1.0
    sevens = [r for r in rows if r.doc_id == 7]
    assert len(sevens) == 2 and len({r.fingerprint for r in sevens}) == 1
    assert f.compare_with_next(empty_docs(spark)).count() == 0
    one = f.compare_with_next(edge_docs(spark).filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
