"""op9: features by definition, the fit, held-out accuracy, and the edge rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_ORACLE
from edge import ROWS, edge_docs, empty_docs
from pyspark.sql import functions as F

from fleetlens.llm import quality_bt as q
from fleetlens.llm.common import table


def plain_measure(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return [0.0] * 12
    n, size = len(words), [len(w.encode()) for w in words]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    up, low = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    windows = Counter(zip(words, words[1:], words[2:]))
    return [
        n,
        sum(size) / n,
        n / len(lines),
        up / max(up + low, 1),
        sum(c.isascii() and c.isprintable() and not c.isalnum() and c != " " for c in text) / sum(size),
        len(re.findall(r"[#*$%&|<>]", text)) / sum(size),
        len(re.findall(r"[0-9]", text)) / sum(size),
        words.count("|") / n,
        sum(c for c in windows.values() if c > 1) / max(n - 2, 1),
        1 - len(set(lines)) / len(lines),
        max(Counter(words).values()) / n,
        1 - len(set(words)) / n,
    ]


def test_measures_by_definition(spark):
    texts = [r.text for r in table(spark, SF_ORACLE, "documents").limit(150).collect()]
    for t in texts + [r[1] for r in ROWS] + ["a | b | c\n\n \nA!! B~\n", "é ü ### 12"]:
        assert q.measure(t) == pytest.approx(plain_measure(t))


def test_fit_orders_by_preference():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.random((400, 12)), rng.random((100, 12))])
    rows[:, 0] = rng.integers(20, 400, 500)
    labels = (rows[:, 5] < 0.4).astype(int)
    model = q.fit(rows, labels)
    s = model.scores(rows)
    assert ((s >= 0.3) == (labels == 1)).mean() > 0.93 and 0 <= s.min() and s.max() <= 1
    raw = model.raw(rows)
    order = np.argsort(raw)
    assert (np.diff(s[order]) >= 0).all()


def test_held_out_accuracy(spark):
    rows = q.query(spark, SF_ORACLE).collect()
    assert len(rows) == 1000
    truth = {r.doc_id: r.quality for r in table(spark, SF_ORACLE, "labels").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(y == p for y, p in held) >= 0.95 * len(held)


def test_held_out_labels_are_not_read(spark):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    turned = labels.withColumn(
        "quality",
        F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    a = {r.doc_id: r.score for r in q.score(docs, labels).collect()}
    b = {r.doc_id: r.score for r in q.score(docs, turned).collect()}
    assert a == b


def test_edge_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (6, 1, 1), (6, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = q.score(edge_docs(spark), labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in q.score(edge_docs(spark), labels.limit(0)).collect()} == {1.0}
    assert q.score(empty_docs(spark), labels).count() == 0
