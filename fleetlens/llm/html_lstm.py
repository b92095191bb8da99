"""Main text of web pages by a recurrent block labeller.

A page's blocks (see ``html_blocks``) form a sequence. Each block is a vector of its hashed tag
path and container names, its hashed words, and a few measures (length, share of links, place,
...). A bidirectional LSTM in numpy reads the whole sequence, so a block is judged by all that
stands before and after it; a logistic layer labels it article or not. The article's blocks
are joined in page order.

The labeller is trained here. ``pages`` has no labels, so a bounded sample of pages
(``MAX_TRAINING_PAGES``) lends its prose, which is dressed in many layouts - with and without
telling element and class names, with menus, headers, notices, adverts, sidebars, forms, reader
comments and footers, unclosed and cut off - whose labels are known. Pages are then read in
Arrow batches, whole, and labelled in groups of similar length.

Defined cases: a null or empty page has an empty text; a page of markup only too; repeated
rows and null ids are rows like any other; other columns are ignored; an empty table gives an
empty result (and trains on layouts around stand-in words).
"""

from __future__ import annotations

import html as entities
import math
import pickle
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import table
from fleetlens.llm.html_blocks import Block, blocks

MAX_TRAINING_PAGES = 200
LEND_BLOCKS, LEND_CHARS = 12, 1500  # of a training page
LAYOUTS = 5_000
EPOCHS = 7
BATCH = 24
HIDDEN = 24
PATH_DIM, WORD_DIM, MEASURES = 128, 32, 10
WIDTH = PATH_DIM + WORD_DIM + MEASURES
RATE = 0.01
SEED = 3
GROUP_CELLS = 20_000  # blocks (with padding) that are labelled together
CACHE = 200_000  # words whose hashes a task keeps


# ---- features -----------------------------------------------------------------------------


class Hashes(dict):
    """word -> its column, remembered."""

    def __init__(self, size: int, salt: str):
        self.size, self.salt = size, salt

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        value = zlib.crc32(f"{self.salt}{word}".encode("utf-8", "surrogatepass")) % self.size
        self[word] = value
        return value


class Features:
    def __init__(self) -> None:
        self.tags = Hashes(PATH_DIM, "t:")
        self.leaves = Hashes(PATH_DIM, "l:")
        self.names = Hashes(PATH_DIM, "n:")
        self.words = Hashes(WORD_DIM, "w:")

    def __call__(self, page: list[Block]) -> np.ndarray:
        x = np.zeros((len(page), WIDTH), dtype=np.float32)
        seen: dict[tuple, np.ndarray] = {}
        for k, b in enumerate(page):
            key = (b.tags, b.names)
            path = seen.get(key)
            if path is None:
                path = np.zeros(PATH_DIM, dtype=np.float32)
                for t in b.tags:
                    path[self.tags[t]] = 1
                for n in b.names:
                    path[self.names[n]] = 1
                if b.tags:
                    path[self.leaves[b.tags[-1]]] += 1
                seen[key] = path
            x[k, :PATH_DIM] = path
            words = b.text.lower().split()
            bag = np.bincount([self.words[w] for w in words], minlength=WORD_DIM)
            x[k, PATH_DIM : PATH_DIM + WORD_DIM] = bag / math.sqrt((bag * bag).sum() + 1)
            n, text = len(b.text), b.text
            x[k, PATH_DIM + WORD_DIM :] = (
                math.log1p(n) / 8,
                math.log1p(len(words)) / 6,
                b.link_chars / n,
                min(1, 20 * (text.count(".") + text.count(",")) / n),
                text[-1] in ".!?:\"'",
                k / len(page),
                math.log1p(k) / 5,
                math.log1p(len(page) - 1 - k) / 5,
                min(1, len(words) / 12),
                1,
            )
        return x


# ---- bidirectional LSTM -------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(x, mask, wx, wh, b, keep=None):
    """Hidden states over time of a batch (time, rows, width); padding leaves states alone."""
    steps, rows, _ = x.shape
    size = wh.shape[0]
    z = (x.reshape(steps * rows, -1) @ wx + b).reshape(steps, rows, -1)
    h, c = np.zeros((rows, size), x.dtype), np.zeros((rows, size), x.dtype)
    out = np.empty((steps, rows, size), x.dtype)
    for t in range(steps):
        a = z[t] + h @ wh
        gates = _sigmoid(a[:, : 3 * size])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        g = np.tanh(a[:, 3 * size :])
        m = mask[t][:, None]
        new_c = f * c + i * g
        tc = np.tanh(new_c)
        if keep is not None:
            keep.append((h, c, i, f, o, g, tc, m))
        c = m * new_c + (1 - m) * c
        h = m * (o * tc) + (1 - m) * h
        out[t] = h
    return out


def _learn_back(x, wh, kept, d_out):
    """Gradients of the input, recurrent and bias weights from those of the hidden states."""
    steps, rows, size = d_out.shape
    dz = np.zeros((steps, rows, 4 * size), x.dtype)
    dwh = np.zeros_like(wh)
    dh = np.zeros((rows, size), x.dtype)
    dc = np.zeros((rows, size), x.dtype)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tc, m = kept[t]
        dh = dh + d_out[t]
        new_h, new_c = m * dh, m * dc
        new_c = new_c + new_h * o * (1 - tc * tc)
        da = np.concatenate(
            [
                new_c * g * i * (1 - i),
                new_c * c * f * (1 - f),
                new_h * tc * o * (1 - o),
                new_c * i * (1 - g * g),
            ],
            axis=1,
        )
        dz[t] = da
        dwh += h.T @ da
        dh = (1 - m) * dh + da @ wh.T
        dc = (1 - m) * dc + new_c * f
    flat = dz.reshape(steps * rows, -1)
    return x.reshape(steps * rows, -1).T @ flat, dwh, flat.sum(axis=0)


class Labeller:
    """Weights: per direction input, recurrent and bias; then the output layer."""

    def __init__(self, rng: np.random.Generator | None = None, weights: list | None = None):
        if weights is not None:
            self.weights = weights
            return

        def matrix(a: int, b: int) -> np.ndarray:
            return (rng.standard_normal((a, b)) / math.sqrt(a)).astype(np.float32)

        self.weights = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN, dtype=np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.weights += [matrix(WIDTH, 4 * HIDDEN), matrix(HIDDEN, 4 * HIDDEN), bias]
        # the output layer sees both directions' states and the block itself
        self.weights += [matrix(2 * HIDDEN + WIDTH, 1)[:, 0], np.zeros(1, dtype=np.float32)]

    def _states(self, x, mask, keep):
        w = self.weights
        ahead = _read(x, mask, *w[0:3], keep[0] if keep else None)
        back = _read(x[::-1], mask[::-1], *w[3:6], keep[1] if keep else None)[::-1]
        return np.concatenate([ahead, back, x], axis=2)

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self._states(x, mask, None) @ self.weights[6] + self.weights[7]

    def gradients(self, x, mask, y):
        keep: tuple[list, list] = ([], [])
        states = self._states(x, mask, keep)
        logits = states @ self.weights[6] + self.weights[7]
        d = (_sigmoid(logits) - y) * mask / mask.sum()
        d_states = d[:, :, None] * self.weights[6]
        first = _learn_back(x, self.weights[1], keep[0], d_states[:, :, :HIDDEN])
        second = _learn_back(
            x[::-1], self.weights[4], keep[1], d_states[::-1, :, HIDDEN : 2 * HIDDEN]
        )
        d_out = (states * d[:, :, None]).sum(axis=(0, 1))
        return [*first, *second, d_out, d.sum(keepdims=True).reshape(1)]


def _padded(group: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(x) for x in group)
    x = np.zeros((steps, len(group), group[0].shape[-1]), dtype=np.float32)
    mask = np.zeros((steps, len(group)), dtype=np.float32)
    for j, own in enumerate(group):
        x[: len(own), j] = own
        mask[: len(own), j] = 1
    return x, mask


def train(examples: list[tuple[np.ndarray, np.ndarray]], seed: int = SEED) -> Labeller:
    """Adam on cross-entropy over (features, labels) of pages."""
    rng = np.random.default_rng(seed)
    net = Labeller(rng)
    first = [np.zeros_like(w) for w in net.weights]
    second = [np.zeros_like(w) for w in net.weights]
    # pages of like length together, groups in random order
    by_length = sorted(range(len(examples)), key=lambda i: len(examples[i][0]))
    groups = [by_length[a : a + BATCH] for a in range(0, len(by_length), BATCH)]
    step, total = 0, EPOCHS * len(groups)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(groups)):
            x, mask = _padded([examples[i][0] for i in groups[k]])
            y, _ = _padded([examples[i][1][:, None] for i in groups[k]])
            # some tag and container names unseen: the rest of the page has to tell
            if rng.random() < 0.3:
                x[:, :, :PATH_DIM] *= rng.random(PATH_DIM) > 0.2
            grads = net.gradients(x, mask, y[:, :, 0])
            norm = math.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for i, g in enumerate(grads):
                g = g * min(1.0, 1.0 / max(norm, 1e-12))
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                up = first[i] / (1 - 0.9**step)
                net.weights[i] -= (
                    rate * up / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    return net


def label(net: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Which blocks of each page belong to the article."""
    out: list[np.ndarray] = [np.zeros(len(x), dtype=bool) for x in pages]
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= GROUP_CELLS:
            end += 1
        x, mask = _padded([pages[i] for i in order[at:end]])
        logits = net.logits(x, mask)
        for j, i in enumerate(order[at:end]):
            out[i] = logits[: len(pages[i]), j] > 0
        at = end
    return out


# ---- layouts for training -----------------------------------------------------------------


class Layouts:
    """Pages of known make-up around lent prose. ``page`` gives html with each text marked."""

    # Usual names of containers, by what they hold.
    MENU = "menu nav navbar navigation topnav mainmenu breadcrumb breadcrumbs".split()
    HEAD = "header masthead topbar site-header branding banner-top".split()
    NOTICE = "cookie cookies notice consent gdpr alert popup modal newsletter-notice".split()
    ADVERT = "ad ads advert advertisement sponsored promo banner sponsor adbox".split()
    SIDE = "sidebar side aside related widget widgets recommended popular more-links".split()
    FORM = "form signup subscribe newsletter search login contact-form".split()
    COMMENT = "comments comment commentlist replies discussion responses".split()
    FOOT = "footer foot bottom copyright site-footer legal".split()
    SHARE = "share social sharing tags meta byline pagination pager".split()
    BODY = "content article post entry main story body text article-body post-content".split()
    PLAIN = "wrap box inner row col container block c1 x2 grid section".split()
    SHORT = (
        "Home|About|Contact|Login|Search|Subscribe|Privacy|Terms|Share|Reply|Next|Previous|Menu|"
        "Read more|Sign up|Comments|Related|Advertisement|Accept cookies|All rights reserved"
    ).split("|")

    def __init__(self, prose: list[str], rng: random.Random):
        self.prose = prose or ["some words that stand for the text of a page, one after the other."]
        self.rng = rng

    def words(self, low: int, high: int) -> str:
        words = self.rng.choice(self.prose).split()
        n = min(self.rng.randint(low, high), len(words))
        at = self.rng.randint(0, len(words) - n)
        return " ".join(words[at : at + n]) or "word"

    def long(self) -> str:
        r = self.rng
        return r.choice(self.prose) if r.random() < 0.6 else self.words(3, 60)

    def short(self) -> str:
        return self.rng.choice(self.SHORT) if self.rng.random() < 0.4 else self.words(1, 4)

    def text(self, value: str, article: bool) -> str:
        """The escaped text, marked with its label (private-use characters)."""
        return ("\ue001" if article else "\ue000") + entities.escape(value, quote=False)

    def box(self, names: list[str], tag: str, inner: str, telling: bool) -> str:
        r = self.rng
        if not telling:
            return f"<div>{inner}</div>" if r.random() < 0.5 else f'<div class="{r.choice(self.PLAIN)}">{inner}</div>'
        name = r.choice(names) + r.choice(["", "", "-wrap", " left", "-1", "Box"])
        style = r.random()
        if style < 0.4 and tag:
            return f"<{tag}>{inner}</{tag}>"
        own = tag if tag and r.random() < 0.3 else "div"
        return f'<{own} {r.choice(["class", "class", "id"])}="{name}">{inner}</{own}>'

    def links(self, n: int) -> str:
        one = [f'<a href="/{i}">{self.text(self.short(), False)}</a>' for i in range(n)]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in one) + "</ul>"
        return "".join(f"<div>{x}</div>" for x in one)

    def other(self, kind: str, telling: bool) -> str:
        r = self.rng
        if kind == "menu":
            return self.box(self.MENU, "nav", self.links(r.randint(2, 8)), telling)
        if kind == "head":
            tag = r.choice(["h1", "div", "p"])
            inner = f"<{tag}>{self.text(self.words(1, 5), False)}</{tag}>"
            if r.random() < 0.5:
                inner += f"<p>{self.text(self.words(2, 10), False)}</p>"
            if r.random() < 0.4:
                inner += self.links(r.randint(2, 5))
            return self.box(self.HEAD, "header", inner, telling)
        if kind == "notice":
            inner = f"<p>{self.text(self.words(4, 40), False)}</p><button>{self.text(self.short(), False)}</button>"
            return self.box(self.NOTICE, "", inner, True)
        if kind == "advert":
            inner = self.text(self.words(3, 40), False)
            if r.random() < 0.5:
                inner = f"<p>{inner}</p>"
            return self.box(self.ADVERT, "", inner, True) if r.random() < 0.5 else f'<div class="ad">{inner}</div>'
        if kind == "side":
            inner = f"<h3>{self.text(self.short(), False)}</h3>" + self.links(r.randint(2, 6))
            if r.random() < 0.5:
                inner += f"<p>{self.text(self.words(5, 40), False)}</p>"
            return self.box(self.SIDE, "aside", inner, True)
        if kind == "form":
            inner = (
                f"<label>{self.text(self.short(), False)}</label><input name=q>"
                f"<button>{self.text(self.short(), False)}</button>"
            )
            if r.random() < 0.5:
                inner = f"<p>{self.text(self.words(3, 20), False)}</p>" + inner
            return f"<form action=/s>{inner}</form>" if r.random() < 0.7 else self.box(self.FORM, "form", inner, True)
        if kind == "comments":
            n = r.randint(1, 5)
            each = [
                f'<div class="comment"><p>{self.text(self.words(1, 3), False)}</p>'
                f"<p>{self.text(self.long(), False)}</p></div>"
                if r.random() < 0.5
                else f"<li><p>{self.text(self.long(), False)}</p></li>"
                if r.random() < 0.5
                else f"<p>{self.text(self.long(), False)}</p>"
                for _ in range(n)
            ]
            tag = r.choice(["h2", "h3", "h4", "p"])
            title = self.text(r.choice(["Comments", f"{n} comments", "Discussion"]), False)
            head = f"<{tag}>{title}</{tag}>" if r.random() < 0.75 else ""
            name = r.choice(self.COMMENT)
            key = r.choice(["id", "class"])
            if r.random() < 0.4:
                each.append(self.other("form", telling))
            own = r.choice(["section", "div", "div", "ol" if r.random() < 0.5 else "ul"])
            return f'<{own} {key}="{name}">{head}{"".join(each)}</{own}>'
        if kind == "share":
            return self.box(self.SHARE, "", self.links(r.randint(1, 4)), True)
        inner = self.text("© " + self.words(1, 12), False)
        if r.random() < 0.3:
            inner = self.links(r.randint(2, 5)) + f"<p>{inner}</p>"
        return self.box(self.FOOT, "footer", inner, telling)

    def article(self, telling: bool) -> str:
        r = self.rng
        parts = []
        if r.random() < 0.8:
            tag = r.choice(["h1", "h1", "h2"])
            parts.append(f"<{tag}>{self.text(self.words(2, 14), True)}</{tag}>")
        p_tag = "p" if r.random() < 0.85 else "div"
        if r.random() < 0.12:  # run on in short lines, often the same one
            line = self.words(1, 4)
            for _ in range(r.randint(4, 60)):
                value = line if r.random() < 0.7 else self.words(1, 6)
                parts.append(f"<{p_tag}>{self.text(value, True)}</{p_tag}>")
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            value = self.long() if r.random() < 0.8 else self.words(1, 8)
            marked = self.text(value, True)
            if kind < 0.06:
                parts.append(f"<h2>{self.text(self.words(1, 8), True)}</h2>")
            elif kind < 0.10:
                items = "".join(f"<li>{self.text(self.words(2, 20), True)}</li>" for _ in range(r.randint(2, 5)))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.14:
                parts.append(f"<blockquote><p>{marked}</p></blockquote>")
            elif kind < 0.17:
                cells = "".join(f"<td>{self.text(self.words(1, 6), True)}</td>" for _ in range(3))
                parts.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.20:
                parts.append(f"<figure><img src=x><figcaption>{self.text(self.words(2, 12), True)}</figcaption></figure>")
            elif kind < 0.26:
                parts.append(f"<{p_tag}><b>{marked}<br><{p_tag}>{self.text(self.long(), True)}")
            elif kind < 0.32:
                parts.append(f"<{p_tag}>{marked} <a href=/l>{entities.escape(self.words(1, 5), quote=False)}</a></{p_tag}>")
            elif kind < 0.36:
                parts.append(f"<p>{marked}")
            else:
                parts.append(f"<{p_tag}>{marked}</{p_tag}>")
            if r.random() < 0.05:
                parts.append(self.other(r.choice(["advert", "share", "side", "form"]), True))
        # what is not the article's own may stand inside its container
        for kind, share in (("share", 0.1), ("comments", 0.2), ("foot", 0.08)):
            if r.random() < share:
                parts.append(self.other(kind, True))
        inner = "".join(parts)
        if not telling:
            return inner if r.random() < 0.3 else f"<div>{inner}</div>"
        if r.random() < 0.5:
            return f"<article>{inner}</article>"
        if r.random() < 0.3:
            return f"<main>{inner}</main>"
        return self.box(self.BODY, "section", inner, True)

    def page(self) -> str:
        r = self.rng
        telling = r.random() < 0.8
        top = [k for k in ("menu", "head", "notice", "advert", "side") if r.random() < 0.4]
        if r.random() < 0.35:
            top = ["menu", "advert"]
        else:
            r.shuffle(top)
        end = [k for k in ("share", "side", "advert", "form", "comments", "notice") if r.random() < 0.25]
        r.shuffle(end)
        if r.random() < 0.85:
            end.append("foot")
        before = "".join(self.other(k, telling or r.random() < 0.5) for k in top)
        after = "".join(self.other(k, telling or r.random() < 0.5) for k in end)
        middle = self.article(telling) if r.random() < 0.97 else ""
        if r.random() < 0.2:
            middle = f'<div class="{r.choice(self.PLAIN)}">{middle}</div>'
        page = f"<html><head><title>x</title></head><body>{before}{middle}{after}</body></html>"
        if r.random() < 0.15:
            page = page[: r.randint(len(page) // 3, len(page))]
        return page

    def example(self, features: Features) -> tuple[np.ndarray, np.ndarray]:
        """Features and labels of one page's blocks; the marks are taken off first."""
        own, labels = [], []
        for b in blocks(self.page()):
            article = "\ue001" in b.text
            text = " ".join(b.text.replace("\ue000", "").replace("\ue001", "").split())
            if text:
                own.append(Block(text, b.tags, b.names, min(b.link_chars, len(text))))
                labels.append(float(article))
        return features(own), np.array(labels, dtype=np.float32)


def learn(pages: DataFrame) -> Labeller:
    """The labeller, trained on layouts around the prose of a bounded sample of pages."""

    def lend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prose = []
            for page in b["html"].to_pylist():
                own = [x.text for x in blocks(page) if len(x.text) >= 40 and 3 * x.link_chars < len(x.text)]
                prose += [t[:LEND_CHARS] for t in sorted(own, key=len)[-LEND_BLOCKS:]]
            yield pa.RecordBatch.from_arrays([pa.array(prose, type=pa.string())], names=["prose"])

    sample = pages.filter("html IS NOT NULL").select(
        "html", F.xxhash64("page_id", "html").alias("h")
    )
    ids = sample.select("h").distinct().orderBy("h").limit(MAX_TRAINING_PAGES)
    chosen = sample.join(F.broadcast(ids), "h").dropDuplicates(["h"])  # hashes: 8 bytes a page
    prose = chosen.select("html").mapInArrow(lend, "prose string").distinct()
    # a row of its own, so that the task below runs on an empty table too
    rows = prose.union(pages.sparkSession.createDataFrame([(None,)], "prose string"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lent = [t for b in batches for t in b["prose"].to_pylist() if t is not None]
        layouts = Layouts(sorted(lent), random.Random(SEED))
        features = Features()
        examples = [layouts.example(features) for _ in range(LAYOUTS)]
        net = train([e for e in examples if len(e[0])])
        blob = pickle.dumps([w.astype(np.float32) for w in net.weights])
        yield pa.RecordBatch.from_arrays([pa.array([blob])], names=["weights"])

    # the sample is bounded (pages, blocks and characters), so one task can hold it
    blob = rows.repartition(1).mapInArrow(fit, "weights binary").first()["weights"]
    return Labeller(weights=pickle.loads(blob))


# ---- on Spark -----------------------------------------------------------------------------


def extract(pages: DataFrame, net: Labeller | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``, ``n_blocks``, ``n_kept`` of every page."""
    net = net or learn(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                read = [blocks(p) for p in b["html"].to_pylist()]
                kept = label(net, [features(own) for own in read])
                texts = [
                    "\n".join(x.text for x, k in zip(own, keep.tolist(), strict=True) if k)
                    for own, keep in zip(read, kept, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        b["page_id"],
                        b["url"],
                        pa.array(texts, type=pa.string()),
                        pa.array([len(t) for t in texts], type=pa.int64()),
                        pa.array([len(own) for own in read], type=pa.int64()),
                        pa.array([int(k.sum()) for k in kept], type=pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every page's main text."""
    return extract(table(spark, sf_dir, "pages"))
