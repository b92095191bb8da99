"""op6: the index against brute force, held-out accuracy, and the edge rows."""

from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_ORACLE, SF_SMALL
from edge import edge_docs, empty_docs
from plain_knn import plain_scores

from fleetlens.llm import toxicity_knn as t
from fleetlens.llm.common import table


def random_index(rng, n, n_terms, groups):
    """Sparse unit vectors; every group of examples has frequent and rare terms of its own."""
    vectors = []
    for e in range(n):
        frequent = np.arange(5) + 5 * (e % groups)
        own = np.arange(5 * groups, n_terms)[e % groups :: groups]
        chosen = rng.choice(own, min(len(own), int(rng.integers(1, 30))), replace=False)
        terms = np.concatenate([frequent[rng.random(5) < 0.7], chosen])
        w = rng.integers(1, 4, len(terms)).astype(float)
        order = np.argsort(terms)
        vectors.append((terms[order], (w / np.sqrt((w * w).sum()))[order]))
    start = np.concatenate([[0], np.cumsum([len(x) for x, _ in vectors])])
    index = t.BlockMaxIndex(
        np.concatenate([x for x, _ in vectors]), np.concatenate([w for _, w in vectors]), start, n_terms
    )
    return vectors, index


@pytest.mark.parametrize(("n", "n_terms", "groups"), [(6000, 9000, 4), (700, 40, 1), (70, 3000, 2), (1, 50, 1)])
def test_block_max_search_is_exact(n, n_terms, groups):
    vectors, index = random_index(np.random.default_rng(3), n, n_terms, groups)
    assert sorted(index.example.tolist()) == list(range(n))
    dense = np.zeros((n, n_terms))
    for e, (terms, w) in enumerate(vectors):
        dense[e, terms] = w
    opened = []
    for e in range(0, n, max(1, n // 150)):
        base = index.base([vectors[e]])[0]
        for without in (-1, e):
            found, cosines, _, blocks = index.nearest(*vectors[e], base, 32, without)
            full = np.round(dense @ dense[e], 9)
            if without >= 0:
                full[without] = 0
            best = np.lexsort((np.arange(n), -full))[:32]
            best = best[full[best] > 0]
            assert found.tolist() == best.tolist()
            assert np.allclose(cosines, full[best])
        opened.append(blocks / index.n_blocks)
    if (n, groups) == (6000, 4):  # terms kept as rows and postings, and blocks that stay closed
        assert len(index.rows) and len(index.place) and np.mean(opened) < 0.7


def test_answers_do_not_depend_on_how_texts_are_grouped():
    vectors, index = random_index(np.random.default_rng(5), 400, 900, 3)
    telling = [np.linspace(0, 1, len(x)) for x, _ in vectors]
    weighed = [(x, w * y) for (x, w), y in zip(vectors, telling)]
    bases, told = index.base(vectors[:64]), index.base(weighed[:64])
    for k in range(0, 64, 9):
        own = index.base([vectors[k]])[0], index.base([weighed[k]])[0]
        alone = index.nearest(*vectors[k], own[0], 16, -1, telling[k], own[1])
        got = index.nearest(*vectors[k], bases[k], 16, -1, telling[k], told[k])
        assert got[0].tolist() == alone[0].tolist() and got[1].tolist() == alone[1].tolist()
        by_term = dict(zip(*(x.tolist() for x in weighed[k])))
        for e, x in zip(got[0].tolist(), got[2].tolist()):
            plain = sum(by_term.get(t, 0.0) * w for t, w in zip(*(x.tolist() for x in vectors[e])))
            assert x == pytest.approx(plain, abs=1e-12)


@pytest.mark.parametrize("rows", [200, 60])
def test_scores_are_the_plain_ones(spark, rows):
    """Weights, neighbours, votes and their fit, over far more words than one block's."""
    docs = table(spark, SF_SMALL, "documents").filter(f"doc_id < {rows}").select("doc_id", "text")
    labels = table(spark, SF_SMALL, "labels").select("doc_id", "toxic")
    plain = plain_scores([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    got = {r.doc_id: r for r in t.score(docs, labels).collect()}
    assert len(got) == len(plain)
    for doc_id, p, near in plain:
        r = got[doc_id]
        assert r.score == pytest.approx(p, abs=1e-6)
        assert len(r.evidence) == min(len(near), t.EVIDENCE)
        for e in r.evidence:
            assert near[e.doc_id] == pytest.approx(e.cosine, abs=2e-9)


def test_a_chunk_has_the_words_of_the_text():
    text = "It's İstanbul ΣΑΣ\x1cΣ a\u00a0b\u2003c x_y ß-Ǆ １２ é " + "长" * 90 + " it'S"
    terms = t.Terms({w: i for i, w in enumerate(dict.fromkeys(t.terms_of(text)))})
    names = {i: w for w, i in terms.known.items()}
    for _ in range(2):  # the second time from the chunks kept
        got = dict(zip(*(x.tolist() for x in terms.counts(text))))
        assert {names[i]: n for i, n in got.items()} == dict(Counter(t.terms_of(text)))


def test_held_out_accuracy(spark):
    rows = t.query(spark, SF_ORACLE).collect()
    assert len(rows) == 1000
    truth = {r.doc_id: r.toxic for r in table(spark, SF_ORACLE, "labels").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    hits = sum(y and p for y, p in held)
    assert hits >= 0.6 * sum(y for y, _ in held)
    assert sum(p and not y for y, p in held) <= 0.02 * len(held)


def test_held_out_labels_are_not_read(spark):
    from pyspark.sql import functions as F

    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    turned = labels.withColumn(
        "toxic", F.when(t.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a = {r.doc_id: r.score for r in t.score(docs, labels).collect()}
    b = {r.doc_id: r.score for r in t.score(docs, turned).collect()}
    assert a == b


def test_edge_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (6, 1, 1), (6, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = t.score(edge_docs(spark), labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    kept = t.keep_clean(edge_docs(spark), labels)
    assert kept.columns == edge_docs(spark).columns and kept.count() <= 11
    none = labels.limit(0)
    assert {r.score for r in t.score(edge_docs(spark), none).collect()} == {0.0}
    assert t.keep_clean(edge_docs(spark), none).count() == 11
    assert t.score(empty_docs(spark), labels).count() == 0
    assert t.keep_clean(empty_docs(spark), labels).count() == 0


def test_every_word_of_the_examples_counts(spark):
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5][:60]
    texts = {i: f"plain common words own{i}" for i in ids}
    for i in ids[:2]:  # far too rare to be among chosen words
        texts[i] = f"bomente own{i}"
    docs = spark.createDataFrame(
        [*texts.items(), (900, "bomente"), (901, f"own{ids[5]}"), (902, "unseen")],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame(
        [(i, int(i in ids[:2])) for i in ids], "doc_id long, toxic int"
    )
    got = {r.doc_id: r for r in t.score(docs, labels).collect()}
    assert [(e.doc_id, e.toxic) for e in got[900].evidence] == [(i, 1) for i in ids[:2]]
    assert [e.doc_id for e in got[901].evidence] == [ids[5]]
    assert got[902].evidence == [] and got[900].score > got[901].score
    model, _, _ = t.learn(docs, labels)
    assert set(model.value.words.to_pylist()) == {w for i in ids for w in t.terms_of(texts[i])}


def test_rare_words_of_held_out_texts_find_neighbours(spark):
    rows = {r.doc_id: r for r in t.query(spark, SF_ORACLE).collect()}
    docs = {r.doc_id: r.text for r in table(spark, SF_ORACLE, "documents").collect()}
    labelled = {r.doc_id for r in table(spark, SF_ORACLE, "labels").filter("toxic is not null").collect()}
    known = {w for i, r in rows.items() if i in labelled and not r.held_out for w in t.terms_of(docs[i])}
    for i, r in rows.items():
        assert bool(r.evidence) == bool(known & set(t.terms_of(docs[i])))


def test_the_sample_is_bounded_by_characters(spark, monkeypatch):
    ids = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5][:40]
    docs = spark.createDataFrame([(i, f"word{i} " * 10) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    assert t.examples(docs, labels).count() == 40
    monkeypatch.setattr(t, "MAX_SAMPLE_CHARS", 1000)
    assert 8 <= t.examples(docs, labels).count() <= 16


class CountedLookups(dict):
    looked_up = 0

    def get(self, *args):
        self.looked_up += 1
        return super().get(*args)


def test_a_chunk_is_looked_up_once_for_many_texts():
    known = CountedLookups({w: i for i, w in enumerate(["plain", "words", "né", "x_y"])})
    texts = ["Plain, words plain", None, "né—words x_y", "", "unknown (words)"] * 40
    terms, tf, start = t.Terms(known).counts_of(texts)
    assert known.looked_up <= 6  # plain, words, né—words, x_y, unknown and none
    names = list(known)
    for k, text in enumerate(texts):
        own = slice(start[k], start[k + 1])
        plain = Counter(w for w in t.terms_of(text) if w in known)
        assert {names[i]: n for i, n in zip(terms[own].tolist(), tf[own].tolist())} == dict(plain)
        assert terms[own].tolist() == sorted(terms[own].tolist())


def small_model():
    texts = [f"common {'bad' if i % 3 == 0 else 'good'} own{i} pair{i // 2}" for i in range(300)]
    words = list(dict.fromkeys(w for x in texts for w in x.split()))
    terms = [sorted(words.index(w) for w in x.split()) for x in texts]
    return texts, t.Model(
        words=pa.array(words),
        terms=np.array([x for own in terms for x in own], dtype=np.int32),
        tf=np.ones(4 * len(texts), dtype=np.int32),
        start=np.arange(0, 4 * len(texts) + 1, 4),
        labels=np.array([float(i % 3 == 0) for i in range(300)]),
        ids=np.arange(300),
        prior=1 / 3,
        rate_without_terms=1 / 3,
        idf=np.linspace(1, 2, len(words)),
    )


def test_frequent_words_are_multiplied_once_for_a_group_of_texts(monkeypatch):
    texts, model = small_model()
    calls, base = [], t.BlockMaxIndex.base
    monkeypatch.setattr(t.BlockMaxIndex, "base", lambda self, v: calls.append(len(v)) or base(self, v))
    got = list(model.answers([*texts[:100], "nothing known"]))
    assert len(got) == 101 and got[-1] == (model.rate_without_terms, [])
    assert sum(calls) == 100 and len(calls) == -(-100 // t.TEXTS_AT_ONCE)


def test_the_index_is_made_without_further_arrays_of_all_postings():
    rng = np.random.default_rng(7)
    n, held = 6000, 200
    terms = (np.arange(held) * 30 + rng.integers(0, 30, (n, held))).ravel().astype(np.int32)
    weights, start = np.full(n * held, held**-0.5), np.arange(0, n * held + 1, held)
    tracemalloc.start()
    index = t.BlockMaxIndex(terms, weights, start, 30 * held)
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(index.place) == n * held and kept >= 12 * n * held
    assert most - kept < 2 * 8 * n * held


def test_rows_are_answered_a_few_at_a_time(monkeypatch):
    texts, model = small_model()
    rows = pa.RecordBatch.from_pydict({"doc_id": range(300), "text": texts})
    learnt = SimpleNamespace(value=model), SimpleNamespace(value=model.idf), (1.0, 0.0)
    whole = [a for _, answers in t._answers(learnt, rows) for a in answers]
    monkeypatch.setattr(t, "SLICE_BYTES", 1000)
    parts = list(t._answers(learnt, rows))
    assert len(parts) > 5 and max(p.num_rows for p, _ in parts) < 100
    assert pa.Table.from_batches([p for p, _ in parts]).to_pydict() == rows.to_pydict()
    got = [a for _, answers in parts for a in answers]
    assert [e for _, e in got] == [e for _, e in whole]
    assert [s for s, _ in got] == pytest.approx([s for s, _ in whole], abs=1e-12)
