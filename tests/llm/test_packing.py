"""op5 against whole-text encoding, and the solver against its lower bounds."""

from __future__ import annotations

import gc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from edge import edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import packing as p
from fleetlens.llm.common import table


def check_packed(rows, texts, capacity):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(p.tokenizer_path())
    expected = Counter()
    for doc_id, text in texts:
        ids = np.array(
            [*tok.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4"
        ).tobytes()
        for k in range(0, len(ids), 4 * capacity):
            own = ids[k : k + 4 * capacity]
            expected[(doc_id, k // (4 * capacity), k // 4, len(own) // 4, zlib.crc32(own))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query_packs_every_document(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = p.query(spark, SF_SMALL).collect()
    n = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], p.CAPACITY)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // p.CAPACITY) + 1


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = p.pack(docs).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], p.CAPACITY)
    assert p.pack(empty_docs(spark)).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "It's  WE'LL nbsp em \x1c fs <|endoftext|> <|startoftext|>x ｆｕｌｌ é ́lone",
        "İstanbul ΣΑΣ ß Ǆ ½ ² ٣ 12a3 ,.!? don't'S 'tis a'b 're",
        "THE!! the&&& don't, don', x<|endoftext|>. İ, क़, é, é. …, a…, ½. Σ? <|STARTOFTEXT|>! É!",
        "x" * 5000 + " ‍​ \x85 \x00 end",
        "J\u030c x H\u0331 T\u0308 W\u030a Y\u030a j\u030c A\u030a O\u0308! e\u0301. J\u030c, <\u0338 =\u0338",
        "KELVIN \u212a \u212b! Ω\u0345 \u0130\u0307 a\u0300\u0301? Z\u0323\u0302 end.\u0301 x!\u0301 Q&A? (A) \"B\"!!",
    ],
)
def test_words_encode_as_in_the_whole_text(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(p.tokenizer_path()).encode(text, add_special_tokens=False).ids
    got = np.frombuffer(p.token_bytes([text], p.tokenizer_path())[0], dtype="<u4")
    assert got.tolist() == whole


@pytest.mark.parametrize("ends_known", [True, False])
def test_plain_words_are_encoded_many_in_a_text(ends_known):
    """Only what is not letters of ASCII and Latin-1 needs the whole tokenizer; words of a text
    whose ends are not all found do, too."""
    from tokenizers import Tokenizer

    path = p.tokenizer_path()
    real, tokens, seen = Tokenizer.from_file(path), p.Tokens(path), []

    class Seen:
        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return real.encode_batch_fast(texts, **options)

    tokens.tokenizer = Seen()
    if not ends_known:
        tokens.last[:] = False
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    words = [f"{i:b}".replace("0", "o").replace("1", "É") + letters[i % 62] for i in range(3000)]
    words += [*letters, "Straße", "ÀÉÎÕÜ", "Zz", "ÿ", "THE", "a" * 300]
    other = ["a×b", "a÷b", "x1", "it's", "z̃", "ª", "ÀA\u0300", "Ž", "—", "a\xa0b", "ａｂ"]
    for end in ("", " z\u0301"):  # the mark keeps Arrow from lower-casing the text
        seen.clear()
        tokens.chunks, tokens.pieces = p.Remembered(10**6), p.Remembered(10**6)
        text = " ".join([*words, *other, *words[:10]]) + end
        got = np.frombuffer(p.token_bytes([text], path, {path: tokens})[0], dtype="<u4")
        assert got.tolist() == real.encode(text, add_special_tokens=False).ids
        plain = {w.lower() for w in words}
        assert {x.lower() for x in seen} & plain == (set() if ends_known else plain)
        assert {"x1", "—", "ａｂ"} <= set(seen)


def test_workers_keep_words_for_their_job_only(spark):
    held = {}
    assert p.token_bytes(["a word"], p.tokenizer_path(), held) == p.token_bytes(["a word"], p.tokenizer_path())
    kept = held[p.tokenizer_path()]
    assert kept.chunks.young.keys() == {b"a", b"word"}
    p.token_bytes(["another word"], p.tokenizer_path(), held)
    assert held[p.tokenizer_path()] is kept and b"another" in kept.chunks.young

    def look(batches):
        known = sum(type(x).__name__ == "Remembered" for x in gc.get_objects())
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"known": [known]})

    texts = spark.range(0, 64, 1, 16).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    assert p.pieces(texts).count() == 64
    after = spark.range(0, 64, 1, 64).mapInArrow(look, "known long").collect()
    assert len(after) == 64 and sum(r.known for r in after) == 0


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=30),
    st.sampled_from([64, 70]),
)
def test_solver_places_every_piece(histogram, capacity):
    groups = p.solve(histogram, capacity)
    placed = Counter()
    for config, n in groups.items():
        assert sum(config) <= capacity
        for l in config:
            placed[l] += n
    assert placed == Counter(histogram)
    big = sum(n for l, n in histogram.items() if 2 * l > capacity)
    area = -(-sum(l * n for l, n in histogram.items()) // capacity)
    plain = sum(p.best_fit_decreasing(histogram, capacity).values())
    assert max(big, area) <= sum(groups.values()) <= plain


def test_solver_on_a_few_pieces():
    assert sum(p.solve({1: 1, 10: 21, 2: 1, 33: 8, 4: 3}, 64).values()) == 8


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_prices_are_updated_at_every_size(spark, monkeypatch, sf):
    """Also where most lengths occur once; and the program is no worse than the heuristic."""
    rows = p.pieces(table(spark, sf, "documents")).groupBy("length").count().collect()
    histogram = {r["length"]: r["count"] for r in rows}
    prices = []

    class Seen(p.Knapsack):
        def __init__(self, lengths, worth, capacity):
            prices.append(dict(zip(lengths.tolist(), worth.tolist(), strict=True)))
            super().__init__(lengths, worth, capacity)

    monkeypatch.setattr(p, "Knapsack", Seen)
    groups = p.solve(histogram)
    changed = [any(a.get(l) != b.get(l) for l in b) for a, b in zip(prices, prices[1:])]
    assert sum(changed) >= p.ROUNDS - 1
    placed = Counter()
    for config, n in groups.items():
        placed.update({l: n * k for l, k in Counter(config).items()})
    assert placed == Counter(histogram)
    area = -(-sum(l * n for l, n in histogram.items()) // p.CAPACITY)
    plain = sum(p.best_fit_decreasing(histogram).values())
    assert area <= sum(groups.values()) <= min(plain, 1.002 * area + 1)


def test_solver_without_small_pieces():
    groups = p.solve({1100: 50, 1500: 70, 2048: 9})
    assert sum(groups.values()) == 129
