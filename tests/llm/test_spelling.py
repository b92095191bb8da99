"""op11 against brute force over all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL
from edge import edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import spelling_pivots as s
from fleetlens.llm.common import table


def plain_words(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    """All words one deletion from the longer, or one replacement apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_near(words):
    """Near words by shared one-deletion neighbours, then checked."""
    holes = defaultdict(set)
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holes[x].add(w)
    near = defaultdict(set)
    for own in holes.values():
        for a in own:
            near[a] |= {b for b in own if a != b and one_edit(a, b)}
    return near


def plain_variants(words):
    near = plain_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x.encode()), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        f = form[w]
        out.add((w, f, root, n, len(near[w]), words[f] if f else None))
    return out


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_query_is_brute_force(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    expected = plain_variants(plain_words(docs))
    rows = [tuple(r) for r in s.query(spark, sf).collect()]
    assert len(rows) == len(expected) and set(rows) == expected
    assert any(r[1] for r in rows) and any(r[4] > 1 for r in rows)


def test_words_of_one_letter_less_or_more(spark):
    near = ["abcdef", "abcdeg", "bbcdef", "abcdefg", "xabcdef", "abxcdef", "abcefd", "éabcdef"]
    near += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "ÿÀÿÀÿÀ", "ÿÀÿÀÿ÷", "ababab", "abababa"]
    words = {w: 5 * 6**k for k, w in enumerate(near)}
    got = {tuple(r) for r in s.near_pairs(spark.createDataFrame([(w,) for w in words], ["word"])).collect()}
    expected = {
        tuple(sorted((a, b), key=str.encode)) for a, own in plain_near(words).items() for b in own
    }
    assert got == expected
    rows = [(1, " ".join(w for w, n in words.items() for _ in range(min(n, 40))))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in s.variants(docs).collect()} == plain_variants(plain_words(rows))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=6, max_size=9), min_size=2, max_size=12, unique=True))
def test_every_near_pair_meets(words):
    order = s.ranked(Counter(g for w in words for g in s.grams(w)))
    index, probes = defaultdict(set), defaultdict(set)
    last = {}
    for w in words:
        places, last[w] = s.prefix_of(w, order)
        pivots = s.pivots_of(places)
        assert len(pivots) == 2 and pivots[1] - pivots[0] >= 2
        for k in s.index_keys(w, [i for i, _ in places]):
            index[k].add(w)
        probes[w] = {k for k in s.probe_keys(w, pivots) if k}
    met = {
        frozenset((w, v)) for w in words for k in probes[w] for v in index[k] if last[w] <= last[v]
    }
    for a, own in plain_near(words).items():
        for b in own:
            assert frozenset((a, b)) in met


def test_pivots_are_the_cheapest_disjoint_pair():
    assert s.pivots_of([(0, 5), (1, 1), (2, 4)]) == [0, 2]
    assert s.pivots_of([(0, 5), (2, 9), (4, 1)]) == [0, 4]
    assert s.pivots_of([(0, 1), (1, 1), (3, 2), (4, 2)]) == [0, 3]


def test_chains_end_in_their_root(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("a", "w4"), ("b", "c")]
    got = dict(tuple(r) for r in s.roots(spark.createDataFrame(forms, ["word", "form"])).collect())
    assert got == {**{f"w{i}": "w11" for i in range(11)}, "a": "w11", "b": "c"}


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = {tuple(r) for r in s.variants(docs).collect()}
    assert rows == plain_variants(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert s.variants(empty_docs(spark)).count() == 0
    long = spark.createDataFrame([(1, "abcdef" * 50_000 + " " + "abcdéf " * 9)], "doc_id long, text string")
    assert [r.word for r in s.variants(long).collect()] == ["abcdéf"]
