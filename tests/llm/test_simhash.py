"""op10 against brute force over all pairs of fingerprints."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from edge import edge_docs, empty_docs

from fleetlens.llm import simhash_gph as s
from fleetlens.llm.common import table
from fleetlens.llm.components import connected_components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, tau=3):
    fps = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= tau).tolist():
            root[find(i)] = find(j)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(low.get(find(i), x), x)
    return [low.get(find(i)) for i in range(len(fps))]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("block_rows", [s.BLOCK_ROWS, 3])
def test_query_matches_brute_force(spark, block_rows):
    docs = table(spark, SF_SMALL, "documents")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    expected = zip(
        [r.doc_id for r in rows],
        [f"{f:016x}" for f in fps],
        plain_components([r.doc_id for r in rows], fps),
        strict=True,
    )
    got = [tuple(r) for r in s.near_duplicates(docs, block_rows=block_rows).collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_links_connect_what_brute_force_connects(spark, block_rows):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = set()
    for c in centres.tolist():
        for _ in range(40):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = connected_components(s.links(df, block_rows=block_rows))
    got = {r.node % (1 << 64): r.root for r in roots.collect()}
    names = plain_components(list(range(len(fps))), fps)
    groups = {}
    for f, name in zip(fps, names, strict=True):
        groups.setdefault(name, []).append(f)
    for members in groups.values():
        labels = {got.get(f, f) for f in members}
        assert len(labels) == 1
    assert len(set(got.values())) == sum(len(m) > 1 for m in groups.values())


def test_every_allocation_is_complete():
    cost, chosen = s.allocate([[0, 5, 9, 9, 9], [0, 1, 2, 9, 9], [0, 1, 9, 9, 9]], 3)
    assert sum(t + 1 for t in chosen) == 4 and cost == 8
    cost, chosen = s.allocate([[0, 50, 90, 90, 90], [0, 1, 2, 3, 4]], 3)
    assert chosen == [-1, 3] and cost == 4


def test_edge_rows(spark):
    got = key(tuple(r) for r in s.near_duplicates(edge_docs(spark)).collect())
    rows = edge_docs(spark).collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    comp = plain_components([r.doc_id for r in rows], fps)
    assert got == key(
        (r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, comp, strict=True)
    )
    assert s.near_duplicates(empty_docs(spark)).count() == 0
    kept = s.keep_one(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert key((r.doc_id,) for r in kept.collect()) == [(1,), (2,), (5,), (6,), (9,), (None,)]
    assert s.keep_one(empty_docs(spark)).count() == 0
