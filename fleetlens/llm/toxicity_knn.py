"""Toxicity by the nearest labelled examples, exact TF-IDF cosine over all of their words.

* *Words*: every word of a bounded sample of labelled rows (at most ``MAX_EXAMPLES`` outside the
  held-out fold, with ``MAX_SAMPLE_CHARS`` of text in all) is a term, however rare. A word that no
  example holds meets nothing.
* *Weights*: (1 + log occurrences) * idf, vectors of length one. Document frequencies are counted
  over all documents, as an array per task.
* *Index*: postings by term, the examples in an order that puts similar ones into a block of
  ``BLOCK``. Terms of more than ``OFTEN`` of the examples are rows over all of them, multiplied for
  ``TEXTS_AT_ONCE`` texts together; postings of terms that at most ``FEW`` examples hold are added
  one by one; terms between have the largest weight of each block. The sums so far bound the
  ``NEIGHBOURS``-th best cosine from below; a block's best sum so far plus its maxima bounds its
  examples from above, and only blocks whose bound reaches the other are opened. So the
  neighbours are exact (cosines to nine digits; ties: the earlier example).
* *Votes*: a neighbour's vote weighs 1 / (1 - cosine + 0.05), times the part of the cosine that
  comes from words that tell the classes apart (each word's share counts by its squared phi
  coefficient with the label among the examples), beside a prior vote of ``PRIOR_MASS``. A logistic
  fit on the sample's leave-one-out votes makes the share of toxic votes a probability. A text
  without a word of any example is nobody's neighbour and gets the smoothed rate of the examples
  that have no words either. ``evidence`` lists the voters of most weight.

Neither the labels of held-out rows nor lang, source or doc_id enter a score.

Defined cases: a null or empty text has no words; a null id is scored and counts as not held
out; repeated rows are scored alike; without usable labels every score is 0; other columns
are ignored by ``score`` and carried by ``keep_clean``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import batch_slices, materialise, table
from fleetlens.llm.learning import held_out, labelled_sample

MAX_EXAMPLES = 8_000
MAX_SAMPLE_CHARS = 100_000_000
NEIGHBOURS = 64
BLOCK = 256
OFTEN = 0.1
FEW = 32  # examples that hold a term whose postings are added before blocks are judged
MARGIN = 1e-9  # over the error of a sum
TEXTS_AT_ONCE = 64
SKETCH = 64  # numbers that a vector is folded into to order the examples
PRIOR_MASS = 0.002
EVIDENCE = 5
SLICE_BYTES = 1_000_000  # of the texts that are held as Python strings at once
THRESHOLD = 0.5

WORD = re.compile(r"\w+")
# UTF-8 with every ASCII character that is in no word made a space
TO_SPACES = bytes(b if b >= 0x80 or WORD.match(chr(b)) else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Terms:
    """Occurrences of known words."""

    def __init__(self, known: dict[str, int]):
        self.known = known

    def codes(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the known words in chunks without white space and ASCII signs, and each
        chunk's first and how many it has."""
        known = self.known
        code = np.array([known.get(c, -1) for c in chunks], dtype=np.int64)
        first, sizes, more = np.arange(len(code)), np.ones(len(code), dtype=np.int64), []
        for i in np.flatnonzero(code < 0).tolist():
            words = []
            if not (chunks[i].isascii() or chunks[i].isalnum()):  # there is a further sign in it
                words = [known[w] for w in WORD.findall(chunks[i]) if w in known]
            first[i], sizes[i] = len(code) + len(more), len(words)
            more += words
        return np.append(code, np.array(more, dtype=np.int64)), first, sizes

    def counts_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the words in the texts, ascending in a text, how often each occurs, and where
        each text's begin, and the last one's end.

        Texts are split by Arrow where they have white space or an ASCII sign, and a chunk is
        looked up once for all of them.
        """
        plain = [(t or "").lower().encode().translate(TO_SPACES) for t in texts]
        ends = np.cumsum([0] + [len(t) for t in plain], dtype=np.int64)
        whole = pa.LargeStringArray.from_buffers(
            len(plain), pa.py_buffer(ends), pa.py_buffer(b"".join(plain))
        )
        split = pc.ascii_split_whitespace(whole)
        chunks = split.flatten().dictionary_encode()
        codes, first, sizes = self.codes(chunks.dictionary.to_numpy(zero_copy_only=False))

        at = chunks.indices.to_numpy()
        sizes = sizes[at]
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
        found = codes[_ranges(first[at], sizes)] + np.repeat(text * len(self.known), sizes)
        found, n = np.unique(found, return_counts=True)
        start = np.searchsorted(found, np.arange(len(texts) + 1) * len(self.known))
        return found % max(len(self.known), 1), n, start

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words in one text, ascending, and how often each occurs."""
        return self.counts_of([text])[:2]


# ---- index --------------------------------------------------------------------------------


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ranges ``first .. first + size`` one after the other."""
    ends = np.cumsum(sizes, dtype=np.int32)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int32) + np.repeat(first - (ends - sizes), sizes)


def similar_order(terms: np.ndarray, weights: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The examples so that blocks of neighbours hold similar ones.

    Vectors are folded into ``SKETCH`` signed sums, which keep inner products about, and the
    examples halved along the direction of most variance until they fit a block.
    """
    n = len(start) - 1
    sketch = np.zeros((n, SKETCH))
    for e in range(0, n, BLOCK):  # the arrays of all postings at once would be a worker's largest
        own = start[e : e + BLOCK + 1]
        run, size = slice(own[0], own[-1]), len(own) - 1
        place = (terms[run].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        sign = np.where(place & np.uint64(1), 1.0, -1.0)
        cell = np.repeat(np.arange(size) * SKETCH, np.diff(own))
        cell += ((place >> np.uint64(1)) % np.uint64(SKETCH)).astype(np.int64)
        folded = np.bincount(cell, weights=weights[run] * sign, minlength=size * SKETCH)
        sketch[e : e + size] = folded.reshape(size, SKETCH)
    out, todo = [], [np.arange(n)]
    while todo:
        own = todo.pop()
        if len(own) <= BLOCK:
            out.append(own)
            continue
        centred = sketch[own] - sketch[own].mean(axis=0)
        _, vectors = np.linalg.eigh(centred.T @ centred)
        order = np.argsort(np.round(centred @ vectors[:, -1], 9), kind="stable")
        half = -(-len(own) // (2 * BLOCK)) * BLOCK  # whole blocks
        todo += [own[order[half:]], own[order[:half]]]
    return np.concatenate([np.zeros(0, np.int64), *out]).astype(np.int64)


def sums_by_term(values: np.ndarray, terms: np.ndarray, start: np.ndarray, n_terms: int) -> np.ndarray:
    """For every term the sum of a value of the examples that hold it."""
    out = np.zeros(n_terms)
    for e in range(0, len(values), BLOCK):
        own = start[e : e + BLOCK + 1]
        weights = np.repeat(values[e : e + BLOCK], np.diff(own))
        out += np.bincount(terms[own[0] : own[-1]], weights=weights, minlength=n_terms)
    return out


class BlockMaxIndex:
    """Exact nearest search over unit vectors (example e at ``start[e]:start[e + 1]``)."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, start: np.ndarray, n_terms: int):
        self.n = len(start) - 1
        self.example = similar_order(terms, weights, start)  # by place
        self.n_blocks = -(-self.n // BLOCK)
        held = sums_by_term(np.ones(self.n), terms, start, n_terms).astype(np.int64)
        often = np.flatnonzero(held > OFTEN * self.n)
        self.row = np.full(n_terms, -1, dtype=np.int32)
        self.row[often] = np.arange(len(often))
        # an example's numbers are side by side, for the neighbours' are read again
        self.columns = np.zeros((self.n_blocks * BLOCK, len(often)))
        self.rows = self.columns.T
        # terms that more than a few examples hold: each block's first posting, and its maximum
        mid = np.flatnonzero((held > FEW) & (self.row < 0))
        self.mid = np.full(n_terms, -1, dtype=np.int32)
        self.mid[mid] = np.arange(len(mid))
        self.block_first = np.zeros((len(mid), self.n_blocks + 1), dtype=np.int32)
        self.block_max = np.zeros((len(mid), self.n_blocks))

        # postings by term and place, put there one example after the other: sorting them all at
        # once would take several arrays of their length
        held[often] = 0
        self.term_first = np.concatenate([[0], np.cumsum(held)])
        self.place = np.zeros(self.term_first[-1], dtype=np.int32)
        self.impact = np.zeros(self.term_first[-1])
        free = self.term_first[:-1].copy()
        for block in range(self.n_blocks):
            self.block_first[:, block] = free[mid]
            for p in range(block * BLOCK, min((block + 1) * BLOCK, self.n)):
                own = slice(start[self.example[p]], start[self.example[p] + 1])
                t, w, row = terms[own], weights[own], self.row[terms[own]]
                self.columns[p, row[row >= 0]] = w[row >= 0]
                t, w = t[row < 0], w[row < 0]
                self.place[free[t]], self.impact[free[t]] = p, w
                free[t] += 1
                some = self.mid[t] >= 0
                t = self.mid[t[some]]
                self.block_max[t, block] = np.maximum(self.block_max[t, block], w[some])
        self.block_first[:, -1] = free[mid]
        # and all of a term's postings, where every block is opened
        self.held = self.block_first[:, -1] - self.block_first[:, 0]
        place, impact = memoryview(self.place), memoryview(self.impact)
        whole = [slice(a, b) for a, b in self.block_first[:, [0, -1]].tolist()]
        self.mid_place = [place[r].cast("B") for r in whole]
        self.mid_impact = [impact[r].cast("B") for r in whole]

    def base(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Sums over the terms kept as rows, by place, for a few texts."""
        often = np.zeros((len(vectors), len(self.rows)))
        for i, (terms, weights) in enumerate(vectors):
            row = self.row[terms]
            often[i, row[row >= 0]] = weights[row >= 0]
        return often @ self.rows

    def nearest(
        self,
        terms: np.ndarray,
        weights: np.ndarray,
        base: np.ndarray,
        k: int,
        without: int = -1,
        telling: np.ndarray | None = None,
        told: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Numbers and cosines of the ``k`` nearest examples with a cosine above 0, nearest first;
        the sums of their products by term, each times the term's ``telling``; and the number of
        blocks opened. ``base`` and ``told`` are those sums over the terms kept as rows, by place;
        without ``told`` the neighbours' are made from their columns."""
        scores, sums = base.copy(), np.zeros_like(base)

        def add(place: np.ndarray, impact: np.ndarray, term: np.ndarray, sizes: np.ndarray) -> None:
            """Add postings, ``sizes`` of each term; ``impact`` becomes the products."""
            nonlocal scores, sums
            place = place.astype(np.intp)
            impact *= np.repeat(weights[term], sizes)
            scores += np.bincount(place, weights=impact, minlength=len(base))
            if telling is not None:
                impact *= np.repeat(telling[term], sizes)
                sums += np.bincount(place, weights=impact, minlength=len(base))

        row, mid = self.row[terms], self.mid[terms]
        few, some = np.flatnonzero((row < 0) & (mid < 0)), np.flatnonzero(mid >= 0)
        first = self.term_first[terms[few]]
        sizes = self.term_first[terms[few] + 1] - first
        at = _ranges(first, sizes)
        add(self.place[at], self.impact[at], few, sizes)
        # what is known so far is a lower bound of every example, so its k-th best is one of the
        # k-th best cosine (one more: `without` may be among them)
        floor = 0.0
        if self.n > k:
            floor = float(np.partition(scores[: self.n], self.n - k - 1)[self.n - k - 1])
        own = mid[some]
        bound = scores.reshape(self.n_blocks, BLOCK).max(axis=1) + weights[some] @ self.block_max[own]
        opened = bound >= max(floor - MARGIN, 1e-12)
        if len(own) and opened.all():
            at = own.tolist()
            place = bytearray().join([self.mid_place[t] for t in at])
            impact = bytearray().join([self.mid_impact[t] for t in at])
            add(np.frombuffer(place, self.place.dtype), np.frombuffer(impact), some, self.held[own])
        elif len(own) and opened.any():
            # runs of blocks that are opened, each a range of a term's postings
            edge = np.flatnonzero(np.diff(np.concatenate([[0], opened.astype(np.int8), [0]])))
            begin = self.block_first[np.ix_(own, edge[::2])].ravel()
            end = self.block_first[np.ix_(own, edge[1::2])].ravel()
            runs = [slice(a, b) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            place = np.concatenate([self.place[r] for r in runs])
            impact = np.concatenate([self.impact[r] for r in runs])
            add(place, impact, np.repeat(some, len(edge) // 2), end - begin)

        found = scores[: self.n]
        if not opened.all():
            found = np.where(np.repeat(opened, BLOCK)[: self.n], found, 0.0)
        if self.n > k:
            floor = float(np.partition(found, self.n - k - 1)[self.n - k - 1])
        place = np.flatnonzero(found >= max(floor - 2 * MARGIN, 1e-12))
        place = place[self.example[place] != without]
        cosines = np.round(found[place], 9)
        best = np.lexsort((self.example[place], -cosines))[:k]
        best = best[cosines[best] > 0]
        place = place[best]
        mass = sums[place]
        if told is not None:
            mass += told[place]
        elif telling is not None:
            x = np.zeros(len(self.rows))
            x[row[row >= 0]] = (weights * telling)[row >= 0]
            mass += self.columns[place] @ x
        return self.example[place], cosines[best], mass, int(opened.sum())


@dataclass
class Model:
    """What the tasks need. Sent as the examples' counts (8 bytes per example and word) and the
    words, before documents are counted; index and word numbers are made from them once per
    worker, which counts and scores with the same numbers."""

    words: pa.Array  # by number
    terms: np.ndarray  # of example e at start[e]:start[e + 1], ascending
    tf: np.ndarray
    start: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    prior: float  # share of toxic examples
    rate_without_terms: float
    idf: np.ndarray | None = None  # known once documents are counted, and sent then
    slope: float = 1.0
    offset: float = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k in self.__dataclass_fields__}

    @cached_property
    def known(self) -> Terms:
        return Terms({w: i for i, w in enumerate(self.words.to_pylist())})

    @cached_property
    def index(self) -> BlockMaxIndex:
        weights = np.empty(len(self.terms))
        for e in range(0, len(self.labels), BLOCK):
            own, start = self.some(range(e, e + BLOCK))
            weights[own] = self.weights(self.terms[own], self.tf[own], start)
        return BlockMaxIndex(self.terms, weights, self.start, len(self.words))

    @cached_property
    def held(self) -> np.ndarray:
        """Examples that hold each word."""
        return sums_by_term(np.ones(len(self.labels)), self.terms, self.start, len(self.words))

    @cached_property
    def held_toxic(self) -> np.ndarray:
        return sums_by_term(self.labels, self.terms, self.start, len(self.words))

    @cached_property
    def share(self) -> float:
        """Of toxic ones among the examples that have words."""
        return float(self.labels.mean()) if len(self.labels) else 0.0

    def some(self, examples: range) -> tuple[slice, np.ndarray]:
        """Where the words of a few examples are, and where each example's begin there."""
        start = self.start[examples.start : examples.stop + 1]
        return slice(start[0], start[-1]), start - start[0]

    def weights(self, terms: np.ndarray, tf: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Of the words of texts that have some, in vectors of length one."""
        w = (1 + np.log(tf)) * self.idf[terms]
        if len(w):
            w /= np.repeat(np.sqrt(np.add.reduceat(w * w, start[:-1])), np.diff(start))
        return w

    def vectors(
        self, terms: np.ndarray, tf: np.ndarray, start: np.ndarray
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of each of a few texts that have words."""
        w = self.weights(terms, tf, start)
        runs = [slice(a, b) for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]
        return [(terms[r], w[r]) for r in runs]

    @cached_property
    def telling_of_all(self) -> np.ndarray:
        return self.telling(np.arange(len(self.words)))

    def telling(self, terms: np.ndarray, without: int = -1) -> np.ndarray:
        """Squared phi of the words with the label, among the examples but one."""
        held, toxic, n, share = self.held[terms], self.held_toxic[terms], len(self.labels), self.share
        if without >= 0:
            n, held, toxic = n - 1, held - 1, toxic - self.labels[without]
        spread = held * share * (1 - share) * (n - held + 1)
        return np.where((held > 0) & (spread > 0), (toxic - held * share) ** 2 / np.maximum(spread, 1e-12), 0.0)

    def votes(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], without: Iterable[int]
    ) -> Iterator[tuple]:
        """Share of toxic votes of a few texts, and the voters' numbers, cosines and weights."""
        if not vectors:
            return
        without = list(without)
        telling = [
            self.telling(t, e) if e >= 0 else self.telling_of_all[t]
            for (t, _), e in zip(vectors, without, strict=True)
        ]
        bases = self.index.base(vectors)
        for (t, w), one, x, base in zip(vectors, without, telling, bases, strict=True):
            near, cosines, mass, _ = self.index.nearest(t, w, base, NEIGHBOURS, one, x)
            power = mass / (1 - np.minimum(cosines, 1) + 0.05)
            share = (power @ self.labels[near] + PRIOR_MASS * self.prior) / (power.sum() + PRIOR_MASS)
            yield float(np.clip(share, 1e-6, 1 - 1e-6)), near, cosines, power

    def answers(self, texts: list[str | None]) -> Iterator[tuple[float, list[dict]]]:
        terms, tf, start = self.known.counts_of(texts)
        some = np.diff(start) > 0
        vectors = self.vectors(terms, tf, np.append(start[:-1][some], start[-1]))
        groups = (vectors[i : i + TEXTS_AT_ONCE] for i in range(0, len(vectors), TEXTS_AT_ONCE))
        votes = chain.from_iterable(self.votes(g, [-1] * len(g)) for g in groups)
        for has_words in some.tolist():
            yield self.answer(*next(votes)) if has_words else (self.rate_without_terms, [])

    def answer(self, share, near, cosines, power) -> tuple[float, list[dict]]:
        x = self.slope * np.log(share / (1 - share)) + self.offset
        first = np.lexsort((near, -cosines, -power))[:EVIDENCE]
        evidence = [
            {"doc_id": int(self.ids[e]), "cosine": c, "toxic": int(self.labels[e]), "weight": w}
            for e, c, w in zip(
                near[first].tolist(), cosines[first].tolist(), power[first].tolist(), strict=True
            )
        ]
        return float(1 / (1 + np.exp(-x))), evidence

    def left_out(self, examples: range) -> list[float]:
        """Shares of toxic votes of a few examples, each without its own."""
        own, start = self.some(examples)
        vectors = self.vectors(self.terms[own].astype(np.int64), self.tf[own], start)
        return [share for share, *_ in self.votes(vectors, examples)]


def fit_votes(shares: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels on the votes' log odds, by Newton steps."""
    design = np.stack([np.log(shares / (1 - shares)), np.ones_like(shares)], axis=1)
    beta, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (p - labels) + (beta - start)  # drawn towards leaving votes as they are
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.05), float(beta[1])


# ---- learning -----------------------------------------------------------------------------


COUNTS = "array<struct<term: string, n: int>>"


def word_counts(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``y``, ``chars`` and ``counts``: all words of ``rows (doc_id, y, text)``."""
    kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in batch_slices(b, "text", SLICE_BYTES):
                texts = part["text"].to_pylist()
                counts = [
                    [{"term": t, "n": n} for t, n in sorted(Counter(terms_of(text)).items())]
                    for text in texts
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["y"],
                        pa.array([len(t or "") for t in texts], type=pa.int64()),
                        pa.array(counts, type=kind),
                    ],
                    names=["doc_id", "y", "chars", "counts"],
                )

    return rows.select("doc_id", "y", "text").mapInArrow(
        run, f"doc_id long, y int, chars long, counts {COUNTS}"
    )


def examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, y, counts`` of the sample: one row per id (of several texts with one id the one of
    the least counts), in the order of ids hashed, as far as the characters go."""
    # ids and labels of the sample only: at most MAX_EXAMPLES rows of 12 bytes are broadcast
    sample = F.broadcast(materialise(labelled_sample(labels, "toxic", MAX_EXAMPLES), "tox-sample"))
    counted = word_counts(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    )
    first = F.min(F.struct("counts", "chars")).alias("first")
    chosen = materialise(counted.groupBy("doc_id", "y").agg(first), "tox-examples")
    sizes = chosen.select("doc_id", F.col("first.chars").alias("chars"), F.xxhash64("doc_id").alias("h"))
    total, keep = 0, []
    for r in sorted(sizes.collect(), key=lambda r: (r["h"], r["doc_id"])):  # MAX_EXAMPLES at most
        total += r["chars"]
        if total <= MAX_SAMPLE_CHARS:
            keep.append(r["doc_id"])
    if len(keep) < MAX_EXAMPLES and total > MAX_SAMPLE_CHARS:
        ids = chosen.sparkSession.createDataFrame([(i,) for i in keep], "doc_id long")
        chosen = chosen.join(F.broadcast(ids), "doc_id", "left_semi")
    return chosen.select("doc_id", "y", F.col("first.counts").alias("c"))


def document_frequencies(docs: DataFrame, model: Broadcast) -> tuple[int, np.ndarray]:
    """The number of documents, and for each of the model's words of those that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = model.value.known
        total, seen = 0, np.zeros(len(terms.known), dtype=np.int64)
        for b in batches:
            total += b.num_rows
            for part in batch_slices(b, "text", SLICE_BYTES):
                seen += np.bincount(terms.counts_of(part["text"].to_pylist())[0], minlength=len(seen))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(found, -1), type=pa.int32()),  # -1: all documents
                pa.array(np.append(seen[found], total), type=pa.int64()),
            ],
            names=["term", "n"],
        )

    counted = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term")
    rows = counted.agg(F.sum("n").alias("n")).toArrow()  # a row per word of the examples
    terms, n = rows["term"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(len(model.value.words), dtype=np.int64)
    out[terms[terms >= 0]] = n[terms >= 0]
    return int(n[terms < 0].sum()), out


def _calibrated(spark: SparkSession, model: Broadcast, idf: Broadcast) -> tuple[float, float]:
    """The fit on the examples' leave-one-out votes, which tasks compute."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        m.idf = idf.value
        for b in batches:
            for e in b["id"].to_pylist():
                own = range(e, min(e + TEXTS_AT_ONCE, len(m.labels)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, type=pa.int64()), pa.array(m.left_out(own), type=pa.float64())],
                    names=["example", "share"],
                )

    labels = model.value.labels
    groups = -(-len(labels) // TEXTS_AT_ONCE)
    starts = spark.range(0, len(labels), TEXTS_AT_ONCE, min(groups, 32))
    got = starts.mapInArrow(run, "example long, share double").toArrow()  # MAX_EXAMPLES rows at most
    shares = np.zeros(len(labels))
    shares[got["example"].to_numpy()] = got["share"].to_numpy()
    return fit_votes(shares, labels)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, Broadcast, tuple[float, float]]:
    """The model and the words' weights, shared with the tasks, and the slope and offset of its votes.

    What is broadcast is bounded by the sample: ``MAX_EXAMPLES`` rows, ``MAX_SAMPLE_CHARS``
    characters, so at most half as many (example, word) pairs.
    """
    spark = docs.sparkSession
    rows = examples(docs, labels).orderBy("doc_id").toArrow().combine_chunks()
    ids, y = rows["doc_id"].to_numpy(), rows["y"].to_numpy().astype(np.float64)
    counts = rows["c"].combine_chunks()
    del rows
    sizes = pc.list_value_length(counts).to_numpy()
    pairs = counts.flatten()
    coded = pairs.field("term").dictionary_encode()
    terms, tf, words = coded.indices.to_numpy(), pairs.field("n").to_numpy(), coded.dictionary
    del counts, pairs, coded
    # words that many examples hold get the low numbers, so that what is known of them is together
    often = np.argsort(-np.bincount(terms, minlength=len(words)), kind="stable")
    number = np.empty(len(words), dtype=np.int32)
    number[often] = np.arange(len(words))
    terms, words = number[terms], words.take(pa.array(often))

    prior = float(y.mean()) if len(y) else 0.0
    some = sizes > 0
    start = np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int64)
    order = np.lexsort((terms, np.repeat(np.arange(len(start) - 1), np.diff(start))))
    model = spark.sparkContext.broadcast(
        Model(
            words=words,
            terms=terms[order].astype(np.int32),
            tf=tf[order].astype(np.int32),
            start=start,
            labels=y[some],
            ids=ids[some],
            prior=prior,
            rate_without_terms=(float(y[~some].sum()) + prior) / (int((~some).sum()) + 1),
        )
    )
    del terms, tf, order
    total, seen = document_frequencies(docs, model)
    idf = spark.sparkContext.broadcast(np.log((1 + total) / (1 + seen)) + 1)
    return model, idf, _calibrated(spark, model, idf) if some.any() else (1.0, 0.0)


# ---- scoring ------------------------------------------------------------------------------


def _answers(
    learnt: tuple[Broadcast, Broadcast, tuple[float, float]], batch: pa.RecordBatch
) -> Iterator[tuple[pa.RecordBatch, list[tuple[float, list[dict]]]]]:
    """A few rows at a time, and their answers."""
    m = learnt[0].value
    m.idf, (m.slope, m.offset) = learnt[1].value, learnt[2]
    for part in batch_slices(batch, "text", SLICE_BYTES):
        yield part, list(m.answers(part["text"].to_pylist()))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``evidence`` for every document."""
    learnt = learn(docs, labels)
    near = pa.list_(
        pa.struct(
            [("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32()), ("weight", pa.float64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [answer for _, answers in _answers(learnt, b) for answer in answers]
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"],
                    pa.array([s for s, _ in got], type=pa.float64()),
                    pa.array([e for _, e in got], type=near),
                ],
                names=["doc_id", "score", "evidence"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(
        run,
        "doc_id long, score double, "
        "evidence array<struct<doc_id: long, cosine: double, toxic: int, weight: double>>",
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, columns as given."""
    learnt = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, answers in _answers(learnt, b):  # the batch is never held twice
                yield part.filter(pa.array([s < THRESHOLD for s, _ in answers], type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every document's toxicity."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
