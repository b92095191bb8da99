"""op2: draws against all segmentations by hand, reproducibility, exact round trips."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from edge import ROWS, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import sampled_pieces as p
from fleetlens.llm.common import table

VOCAB = p.Vocabulary(p.model_path())
PIECES = {b.decode(): i for i, b in reversed(list(enumerate(VOCAB.bytes))) if i > 258}


def segmentations(text):
    """All paths over a text and their log weights."""
    if not text:
        return [((), 0.0)]
    out = []
    for k in range(1, min(16, len(text)) + 1):
        head = text[:k]
        if head in PIECES:
            step = ((PIECES[head],), VOCAB.weight[PIECES[head]])
        elif k == 1:
            raw = head.encode()
            step = (tuple(VOCAB.byte_id[b] for b in raw), len(raw) * VOCAB.byte_weight)
        else:
            continue
        out += [(step[0] + rest, step[1] + w) for rest, w in segmentations(text[k:])]
    return out


@pytest.mark.parametrize("text", ["the", "reading, x", "a  b", "é▁z"])
def test_draws_follow_the_path_weights(text):
    paths = segmentations(" " + text)
    total = math.log(sum(math.exp(w) for _, w in paths))
    n = 20_000
    ids, ends = p.encode_texts(list(range(n)), [text] * n, VOCAB)
    got = Counter(tuple(x.tolist()) for x in np.split(ids, ends[:-1]))
    assert set(got) <= {s for s, _ in paths}
    for s, w in paths:
        share = math.exp(w - total)
        assert abs(got[s] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 3 / n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=5), st.integers(-9, 9))
def test_round_trip(texts, key):
    ids, ends = p.encode_texts([key] * len(texts), texts, VOCAB)
    for t, own in zip(texts, np.split(ids, ends[:-1]) if texts else [], strict=True):
        assert p.decode_ids(own.tolist(), VOCAB) == (t or "")


@pytest.mark.parametrize(
    "text",
    ["▁ ▁▁  ▁", "<s></s><unk><0x0A>", " lead", "trail  ", "\n\t\r\x00", "𝔘ñí é́ 漢字かな العربية ไทย", " "],
)
def test_hard_round_trips(text):
    ids, _ = p.encode_texts([3], [text], VOCAB)
    assert p.decode_ids(ids.tolist(), VOCAB) == text
    assert not set(ids.tolist()) & {0, 1, 2}


def test_rows_do_not_depend_on_their_batch():
    texts = ["some words here", "others, and words", "some words here", None, ""]
    alone = [p.encode_texts([k], [t], VOCAB)[0].tolist() for k, t in enumerate(texts)]
    ids, ends = p.encode_texts(list(range(5)), texts, VOCAB)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == alone


def test_kept_lattices_do_not_show():
    segment = p.Segmenter(VOCAB)
    for k in range(3 * p.KEPT_SLICES):
        texts = [f"common words and rare{k} ones", None, f"x{k}, common words é{k}漢"]
        ids, ends = segment([k, 1, None], texts)
        again, ends_again = p.encode_texts([k, 1, None], texts, VOCAB)
        assert ids.tolist() == again.tolist() and ends.tolist() == ends_again.tolist()


def test_alpha_and_seed():
    text = "segmentations of ordinary words " * 30
    sharp = p.Vocabulary(p.model_path(), alpha=8.0)
    few, _ = p.encode_texts([1], [text], sharp)
    many, _ = p.encode_texts([1], [text], VOCAB)
    assert len(few) < len(many)
    assert p.encode_texts([1], [text], VOCAB, 7)[0].tolist() != many.tolist()


def test_query_is_lossless_and_stable(spark):
    rows = p.query(spark, SF_SMALL).collect()
    docs = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.lossless and r.n_pieces == len(r.piece_ids)
        assert p.decode_ids(r.piece_ids, VOCAB) == docs[r.doc_id]
    shuffled = p.encode(table(spark, SF_SMALL, "documents").repartition(5)).collect()
    assert {r.doc_id: r.piece_ids for r in shuffled} == {r.doc_id: r.piece_ids for r in rows}


def test_edge_rows(spark):
    out = p.decode(p.encode(edge_docs(spark)))
    assert out.columns == [*edge_docs(spark).columns, "piece_ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(ROWS)
    assert all(r.decoded == r.text and (r.piece_ids is None) == (r.text is None) for r in rows)
    assert len({tuple(r.piece_ids) for r in rows if r.doc_id == 7}) == 1
    assert p.decode(p.encode(empty_docs(spark))).count() == 0
