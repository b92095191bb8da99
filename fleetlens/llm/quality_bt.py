"""Document quality by Bradley-Terry ranking.

* *Features* of the whole text, computed in Arrow batches: lengths, and shares of capitals,
  signs, digits, pipes, repeated words, windows and lines; shares are taken on a curve, and
  each also stands as steps, so a linear score can bend.
* *Preferences*: in a bounded sample of labelled rows outside the held-out fold, every
  document with the better label is preferred to ``RIVALS`` of the worse ones, dealt in turn.
  P(a preferred to b) = sigmoid(s(a) - s(b)) with s linear in the features, so the fit is a
  logistic regression without intercept on feature differences (Newton steps, ridge).
* *Threshold*: preferences fix scores only up to a shift. The cut is the quantile of the
  sample's scores at which the sample's two kinds part best (largest sum of both kinds' shares
  on their own side, halfway between the two neighbouring scores); it becomes ``THRESHOLD``
  on the final scale, and below and above it a score is the share of the sample's scores that
  it passes, so it grows with the raw score everywhere.

Neither the labels of held-out rows nor lang, source or doc_id enter a score.

Defined cases: a null or empty text has all features of a text without words; a null id is
scored and counts as not held out; repeated rows are scored alike; without both labels in the
sample every score is 1; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import materialise, table
from fleetlens.llm.learning import held_out, labelled_sample

MAX_EXAMPLES = 12_000
RIVALS = 8
RIDGE = 1e-2
THRESHOLD = 0.3
STEPS = (0.02, 0.1, 0.25, 0.5)  # of the shares
WORD_STEPS = (10, 20, 30, 50, 80)

SIGNS = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + b"[\\]^_`{|}~"
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER, DIGITS = (
    bytes(range(0x41, 0x5B)),
    bytes(range(0x61, 0x7B)),
    bytes(range(0x30, 0x3A)),
)
LINE = re.compile(rb"[^\n]+")
SHARES = ("upper", "signs", "symbols", "digits", "pipes", "windows", "lines", "common", "same")


def _left(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def measure(text: str | None) -> list[float]:
    """Number of words, mean word length, mean line length, and the ``SHARES``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * (3 + len(SHARES))
    letters = sum(len(w) for w in words)
    upper, lower = _left(data, UPPER), _left(data, LOWER)
    lines = [x for x in LINE.findall(data) if not x.isspace()]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = sum(c for c in windows.values() if c > 1)
    counts = Counter(words)
    return [
        float(n),
        letters / n,
        n / len(lines),
        upper / max(upper + lower, 1),
        _left(data, SIGNS) / letters,
        _left(data, SYMBOLS) / letters,
        _left(data, DIGITS) / letters,
        counts[b"|"] / n,
        again / max(n - 2, 1),
        1 - len(set(lines)) / len(lines),
        counts.most_common(1)[0][1] / n,
        1 - len(counts) / n,
    ]


def features(rows: np.ndarray) -> np.ndarray:
    """Columns that a linear score is taken over, from rows of ``measure``."""
    n, word, line, shares = rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3:]
    columns = [np.log1p(n), np.log1p(word), np.log1p(line)]
    columns += [n >= s for s in WORD_STEPS]
    columns += [(word >= 2) & (word <= 15)]
    for j in range(shares.shape[1]):
        columns.append(np.sqrt(np.clip(shares[:, j], 0, None)))
        columns += [shares[:, j] >= s for s in STEPS]
    return np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    below: np.ndarray  # the sample's raw scores under the cut, sorted
    above: np.ndarray
    cut: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return (features(rows) - self.mean) / self.scale @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.ones(len(rows))
        x = self.raw(rows)

        def passed(sample: np.ndarray) -> np.ndarray:
            # share of the sample's scores that x passes, straight lines between them
            at = np.searchsorted(sample, x, side="left") + np.searchsorted(sample, x, side="right")
            return (at + 1) / (2 * len(sample) + 2)

        low = THRESHOLD * passed(self.below)
        high = THRESHOLD + (1 - THRESHOLD) * passed(self.above)
        return np.where(x < self.cut, low, high)


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """The model from measured rows and their labels."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    none = np.empty(0)
    if not len(good) or not len(bad):
        return Model(none, none, none, none, none, 0.0)
    x = features(rows)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (x - mean) / scale
    # every good one meets RIVALS bad ones, and every bad one meets good ones, dealt in turn
    a = np.repeat(good, RIVALS)
    b = bad[np.arange(len(a)) % len(bad)]
    d = x[a] - x[b]
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(np.clip(d @ beta, -30, 30)))  # chance of the other outcome
        grad = -(d.T @ p) / len(d) + RIDGE * beta
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    raw = x @ beta
    order = np.argsort(raw, kind="stable")
    s, y = raw[order], labels[order]
    parted = np.cumsum(y == 0) / len(bad) - np.cumsum(y == 1) / len(good)
    parted[:-1][s[:-1] == s[1:]] = -np.inf  # no cut between equal scores
    k = int(np.argmax(parted))
    cut = (s[k] + s[k + 1]) / 2 if k + 1 < len(s) else s[k] + 1
    return Model(mean, scale, beta, s[s < cut], s[s >= cut], float(cut))


# ---- on Spark -----------------------------------------------------------------------------


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``m`` (see ``measure``) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(rows, type=pa.list_(pa.float64()))], names=["doc_id", "m"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, m array<double>")


def learn(rows: DataFrame, labels: DataFrame) -> Model:
    """The model from measured documents and a bounded sample of their labels."""
    # ids and labels of the sample only: at most MAX_EXAMPLES rows of 12 bytes are broadcast
    sample = materialise(labelled_sample(labels, "quality", MAX_EXAMPLES), "quality-sample")
    # one row per id (of several texts with one id the least)
    examples = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y")
    got = sorted((r["doc_id"], r["y"], r["m"]) for r in examples.agg(F.min("m").alias("m")).collect())
    width = 3 + len(SHARES)
    return fit(
        np.array([m for _, _, m in got], dtype=np.float64).reshape(-1, width),
        np.array([y for _, y, _ in got], dtype=np.int64),
    )


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every document."""
    rows = materialise(measured(docs), "quality-measured")
    model = learn(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = np.stack(b["m"].to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], pa.array(model.scores(m))], names=["doc_id", "score"]
                )

    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every document's quality."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
