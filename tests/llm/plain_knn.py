"""op6 the plain way: dense vectors, all cosines, votes and their fit, without index or Spark."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np

from fleetlens.llm import toxicity_knn as t


def plain_scores(docs, labels):
    """Score and nearest voters of every ``(doc_id, text)``; ``labels``: ``(doc_id, toxic)``, one
    text per labelled id, all of the sample taken."""
    words = [Counter(re.findall(r"\w+", (text or "").lower())) for _, text in docs]
    label = {i: y for i, y in labels if i is not None and y is not None}
    own = {i: w for (i, _), w in zip(docs, words)}
    sample = sorted(i for i in label if i in own and zlib.crc32(str(i).encode()) % 5)
    prior = np.mean([label[i] for i in sample]) if sample else 0.0
    empty = [label[i] for i in sample if not own[i]]
    some = [i for i in sample if own[i]]
    y = np.array([label[i] for i in some], dtype=float)
    terms = {w: k for k, w in enumerate(sorted({w for i in some for w in own[i]}))}
    df = Counter(w for c in words for w in c)
    idf = np.array([math.log((1 + len(docs)) / (1 + df[w])) + 1 for w in terms])

    def vector(c):
        v = np.zeros(len(terms))
        for w, n in c.items():
            if w in terms:
                v[terms[w]] = (1 + math.log(n)) * idf[terms[w]]
        return v / (np.linalg.norm(v) or 1)

    dense = np.array([vector(own[i]) for i in some]).reshape(len(some), len(terms))
    holds = (dense > 0).astype(float)

    def vote(v, without=None):
        rest = [k for k in range(len(some)) if k != without]
        n, held, toxic = len(rest), holds[rest].sum(axis=0), y[rest] @ holds[rest]
        share = y.mean()
        phi = np.zeros(len(terms))
        ok = (held > 0) & (held * share * (1 - share) > 0)
        phi[ok] = ((toxic - held * share) ** 2)[ok] / (held * share * (1 - share) * (n - held + 1))[ok]
        cos = np.round(dense @ v, 9)
        near = [k for k in sorted(rest, key=lambda k: (-cos[k], k))[: t.NEIGHBOURS] if cos[k] > 0]
        power = np.array([(dense[k] * v * phi).sum() / (1 - min(cos[k], 1) + 0.05) for k in near])
        got = (power @ y[near] + t.PRIOR_MASS * prior) / (power.sum() + t.PRIOR_MASS) if near else prior
        return min(max(got, 1e-6), 1 - 1e-6), {some[k]: cos[k] for k in near}

    slope, offset = 1.0, 0.0
    if some:
        slope, offset = t.fit_votes(np.array([vote(dense[k], k)[0] for k in range(len(some))]), y)
    out = []
    for (doc_id, _), c in zip(docs, words):
        if any(w in terms for w in c):
            share, near = vote(vector(c))
            out.append((doc_id, 1 / (1 + math.exp(-(slope * math.log(share / (1 - share)) + offset))), near))
        else:
            out.append((doc_id, (sum(empty) + prior) / (len(empty) + 1), {}))
    return out
