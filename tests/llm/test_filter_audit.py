"""op12 against DuckDB, a plain count of every order, and the matrix against its texts."""

from __future__ import annotations

from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from differential import compare, duck
from edge import edge_docs, empty_docs

from fleetlens.llm import filter_audit as f
from fleetlens.llm.common import table


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_matches_duckdb(spark, sf):
    ok, msg = compare(spark, duck(sf), sf, "op12", f.query, f.ORACLE)
    assert ok, msg


def plain_audit(docs, labels):
    """Rows by applying every order, document by document."""
    texts = [t or "" for _, t, _ in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for (i, _, _), t in zip(docs, texts):
        words = t.encode().split()
        own = set()
        own |= {"A"} if len(words) < 50 else set()
        own |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        own |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        own |= {"D"} if set(t) & set("#$%&*|") else set()
        smaller = any(
            t == u and i is not None and j is not None and j < i for (j, _, _), u in zip(docs, texts)
        )
        own |= {"E"} if smaller else set()
        fails.append(own)
    out = {}
    for part in {s or "" for _, _, s in docs}:
        mine = [(d[0], x) for d, x in zip(docs, fails) if (d[2] or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [(i, y) for i, y in left if x in y]
                left = [(i, y) for i, y in left if x not in y]
                shapley[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(x in y for _, y in mine) - len(gone),
                    sum(y == {x} for _, y in mine),
                    sum(i in good for i, _ in gone),
                    sum(i in bad for i, _ in gone),
                ]
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[x])
    return out


def test_edge_rows(spark):
    docs = edge_docs(spark).withColumn("part", f.F.lit("clash")).withColumn("digest", f.F.lit(1))
    labels = spark.createDataFrame(
        [(1, 1, 0), (7, 0, 1), (7, 1, 0), (6, None, None), (None, 1, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = {(r[0], r[1], r[2]): list(r)[3:] for r in f.audit(docs, labels).collect()}
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got == plain_audit(plain, [tuple(r) for r in labels.collect()])
    assert len(got) == 2 * 600
    none = labels.limit(0)
    assert all(r.good_lost == r.toxic_lost == 0 for r in f.audit(docs, none).collect())
    assert f.audit(empty_docs(spark), labels).count() == 0


def test_matrix_holds_every_word(spark):
    docs = table(spark, SF_SMALL, "documents").repartition(5)
    shards, n_words = f.matrix(docs, shard_bytes=50_000)
    rows = shards.collect()
    assert len(rows) > 5
    of_number, seen = {}, 0
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    runs = f.materialise(f.shards(docs, 50_000), "test-shards")
    assert {w for r in runs.collect() for w in bytes(r.words).split(b"\n")} == {
        w for t in texts.values() for w in t.split()
    }
    sets = Counter()
    columns = set()
    for r in rows:
        indptr = np.frombuffer(r.indptr, dtype=np.int32)
        indices = np.frombuffer(r.indices, dtype=np.int64)
        counts = f.numbers(r.counts, len(indices))
        columns |= set(indices.tolist())
        for k, doc_id in enumerate(r.doc_id):
            own = slice(indptr[k], indptr[k + 1])
            words = Counter(texts[doc_id].split())
            assert Counter(counts[own].tolist()) == Counter(words.values())
            # a column stands for one word: the words with its number and count stay possible
            for number, n in zip(indices[own].tolist(), counts[own].tolist()):
                may = {w for w, m in words.items() if m == n}
                of_number[number] = of_number.get(number, may) & may
                assert of_number[number]
            assert len(set(indices[own].tolist())) == len(words)
            sets[frozenset(words)] += 1
            seen += 1
    assert seen == len(texts)
    assert sorted(columns) == list(range(n_words))
    assert n_words == len({w for t in texts.values() for w in t.split()})


def test_one_long_text_is_one_row(spark):
    text = "a b# " * 400_000
    docs = spark.createDataFrame([(1, text, "s"), (2, "x", "s")], "doc_id long, text string, source string")
    rows = f.measures(f.matrix(docs)[0]).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_distinct, r.signs) for r in rows] == [(800_000, 2, True), (1, 1, False)]
    assert np.all([len(r.digest) == 32 for r in rows])
