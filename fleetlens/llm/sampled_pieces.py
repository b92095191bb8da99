"""Sampled SentencePiece segmentation, and lossless decoding.

A text's piece lattice has a node between any two characters and an edge for every piece that
spells what lies between two nodes; a segmentation is a path. Paths are drawn with probability
proportional to the product of their pieces' weights by *forward filtering and backward
sampling*: forward sums give every node the total weight of the paths up to it, and from the
end an edge is drawn at each node by its share of that sum. ``alpha`` sharpens (above 1) or
flattens the distribution; piece probabilities follow Zipf's law on the vocabulary's ranks,
since the scores of a BPE model are ranks.

* A draw is a 32-bit hash of (seed, row key, position in the text), compared with thresholds
  kept in whole numbers, so a row's segmentation depends on its key and text alone: not on
  partitions, batches or retries.
* No piece joins Latin letters or digits to other signs, or anything to a following space
  (checked when the vocabulary is read), so the lattice falls apart into chunks there; each distinct
  chunk of a batch is filtered once and all its occurrences are drawn from the same sums.
* Characters without a piece become their UTF-8 bytes' pieces. The space mark of the vocabulary
  stands for a space, so a text's own U+2581 is written in bytes too: decoding gives back
  every text exactly.

Defined cases: a null text has null ids (and decodes to null); an empty text is the leading
space alone; a null key is a key of its own; equal rows get equal segmentations; other columns
are carried by ``encode`` and ``decode``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import table, text_slices

MODEL = "piece_bpe_32k.model"
ALPHA = 1.0
SEED = 20
ZIPF_SHIFT = 2.7
SPACE_MARK = "▁"
LATIN = "A-Za-z0-9À-ÖØ-öø-ɏ"  # letters and digits; U+00D7 and U+00F7 are signs
CHUNK = re.compile(f" *[{LATIN}]+| *[^ {LATIN}]+| +")
PIECE = re.compile(f" *(?:[{LATIN}]+|[^ {LATIN}]+)?")
SLICE_CHARS = 1_000_000  # of the texts whose lattices are built together
KEPT_SLICES = 3
CODE_BITS = 21  # of a code point
GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # splitmix64's increment and multipliers
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Piece bytes and weights by id, and a trie of the pieces."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_id = [-1] * 256
        total = math.log(sum(1 / (r + ZIPF_SHIFT) for r in range(n)))
        weight = np.zeros(n)
        pieces: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            rank = min(-model.get_score(i), float(n))
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                rank = float(n)
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                spelt = piece.replace(SPACE_MARK, " ")
                self.bytes.append(spelt.encode("utf-8"))
                if not PIECE.fullmatch(spelt):
                    raise ValueError(f"piece {piece!r} crosses a chunk")
                pieces.setdefault(spelt, i)
            weight[i] = -alpha * (math.log(rank + ZIPF_SHIFT) + total)
        self.weight = weight
        self.byte_weight = -alpha * (math.log(n + ZIPF_SHIFT) + total)
        # A trie by depth: a prefix of length k is known by its number among those of its length,
        # found by (number of its first k - 1 characters, last character).
        self.depths: list[Steps] = []
        number = {"": 0}
        for k in range(1, max(map(len, pieces)) + 1):
            own = sorted({p[:k] for p in pieces if len(p) >= k})
            keys = [number[p[:-1]] << CODE_BITS | ord(p[-1]) for p in own]
            number = {p: i for i, p in enumerate(own)}
            self.depths.append(Steps(keys, [pieces.get(p, -1) for p in own]))


class Steps:
    """A hash table from trie steps to prefix numbers, looked up for whole arrays at once."""

    def __init__(self, keys: list[int], pieces: list[int]):
        self.shift = np.uint64(64 - max(10, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size + 1, -1, dtype=np.int64)
        self.numbers = np.zeros(size + 1, dtype=np.int64)
        self.pieces = np.array(pieces, dtype=np.int64)
        for i, (key, at) in enumerate(zip(keys, self._slots(np.array(keys)).tolist(), strict=True)):
            while self.keys[at] >= 0:
                at = (at + 1) % size
            self.keys[at], self.numbers[at] = key, i
        self.size = size

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Prefix numbers, -1 where there is none."""
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.numbers[at], -1)
        on = np.flatnonzero((there != keys) & (there >= 0))
        while len(on):
            at[on] = (at[on] + 1) % self.size
            there = self.keys[at[on]]
            same = there == keys[on]
            out[on[same]] = self.numbers[at[on[same]]]
            on = on[~same & (there >= 0)]
        return out


class Lattice:
    """Forward sums and draw thresholds of distinct chunks, laid end to end.

    Chunk c has nodes ``first[c] .. first[c] + length`` (one more than its characters). The edges
    into a node stand together, shorter pieces first, with running thresholds in 32 bits.
    """

    def __init__(self, chunks: list[str], vocab: Vocabulary):
        lengths = np.array([len(c) for c in chunks], dtype=np.int64)
        raw = "".join(chunks).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, dtype=np.uint32).astype(np.int64)
        chars = np.concatenate([[0], np.cumsum(lengths)])
        self.lengths = lengths
        self.first = chars[:-1] + np.arange(len(chunks))
        owner = np.repeat(np.arange(len(chunks)), lengths)
        left = np.repeat(chars[1:], lengths) - np.arange(len(codes))  # to the chunk's end
        source = np.arange(len(codes)) + owner  # the node before each character

        # edges by size: where they start and their pieces; then laid out by end and size
        starts, ids = [], []
        at = np.arange(len(codes))
        prefix = np.zeros(len(codes), dtype=np.int64)
        for k, steps in enumerate(vocab.depths, 1):
            if k > 1:
                ok = left[at] >= k
                at, prefix = at[ok], prefix[ok]
            if not len(at):
                break
            found = steps.find(prefix << CODE_BITS | codes[at + (k - 1)])
            hit = found >= 0
            at, prefix = at[hit], found[hit]
            own = steps.pieces[prefix]
            done = own >= 0
            starts.append(at[done])
            ids.append(own[done])
        # a character without a piece has an edge for its bytes, numbered below zero
        bare = np.ones(len(codes), dtype=bool)
        bare[starts[0]] = False
        bare = np.flatnonzero(bare)
        starts.append(bare)
        ids.append(-1 - codes[bare])
        sizes = [*range(1, len(starts)), 1]

        nodes_in_all = len(codes) + len(lengths)
        fan = np.zeros(nodes_in_all, dtype=np.int64)  # edges into each node
        for k, own in zip(sizes, starts, strict=True):
            fan[source[own] + k] += 1
        heads = np.concatenate([[0], np.cumsum(fan)[:-1]])
        n_edges = int(fan.sum())
        self.piece = np.empty(n_edges, dtype=np.int64)
        self.size = np.empty(n_edges, dtype=np.int64)
        self.source = np.empty(n_edges, dtype=np.int64)
        weight = np.empty(n_edges)
        filled = heads.copy()
        for k, own, piece in zip(sizes, starts, ids, strict=True):
            node = source[own]
            place = filled[node + k]
            filled[node + k] += 1
            self.piece[place], self.size[place], self.source[place] = piece, k, node
            weight[place] = (
                vocab.weight[piece]
                if own is not bare
                else vocab.byte_weight * (np.digitize(-1 - piece, [0x80, 0x800, 0x10000]) + 1)
            )

        # forward sums (logs), one character further in all chunks at a time
        node = source + 1  # every node but the chunks' first
        depth = node - self.first[owner]
        small = depth.astype(np.int16) if depth.max(initial=0) < 32_000 else depth
        by_depth = node[np.argsort(small, kind="stable")]
        forward = np.zeros(nodes_in_all)
        path = np.empty(n_edges)
        a = 0
        for n in np.bincount(depth)[1:].tolist():
            own = by_depth[a : a + n]
            a += n
            begin = np.concatenate([[0], np.cumsum(fan[own])])
            edges = np.repeat(heads[own] - begin[:-1], fan[own]) + np.arange(begin[-1])
            path[edges] = forward[self.source[edges]] + weight[edges]
            forward[own] = np.logaddexp.reduceat(path[edges], begin[:-1])

        # thresholds: running shares of the edges into a node, summed node by node
        upto = np.exp(path - np.repeat(forward, fan))
        more, k = np.flatnonzero(fan > 1), 1
        while len(more):
            at = heads[more] + k
            upto[at] += upto[at - 1]
            k += 1
            more = more[fan[more] > k]
        self.heads = heads
        self.last = heads + fan - 1
        self.threshold = np.minimum(np.floor(upto * 2.0**32), 2.0**32).astype(np.int64)

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Edges into ``node``, drawn with the 32-bit numbers ``u``: the first whose threshold
        is above ``u``, sought from the longest piece (mostly the one) down."""
        u = u.astype(np.int64)
        edge, head = self.last[node], self.heads[node]
        on = np.flatnonzero((edge > head) & (u < self.threshold[edge - 1]))
        while len(on):
            edge[on] -= 1
            now = edge[on]
            on = on[(now > head[on]) & (u[on] < self.threshold[now - 1])]
        return edge


class Segmenter:
    """Encodes slices of texts; the lattices of the first ``KEPT_SLICES`` slices' chunks, which
    hold most words of later ones, are kept. What is drawn does not depend on it."""

    def __init__(self, vocab: Vocabulary, seed: int = SEED):
        self.vocab, self.seed = vocab, seed
        # chunks are numbered as they come; lattice i has those from first[i] on
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.kept: list[tuple[int, Lattice]] = []

    def __call__(
        self, keys: list[int | None], texts: list[str | None]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids end; nulls have none."""
        before = len(self.index)
        words: list[int] = []
        counts = []
        for t in texts:
            found = CHUNK.findall(" " + t) if t is not None else []
            counts.append(len(found))
            words += map(self.index.__getitem__, found)
        new = list(islice(self.index, before, None))
        lattices = self.kept + ([(before, Lattice(new, self.vocab))] if new else [])
        if len(self.kept) < KEPT_SLICES:
            self.kept = lattices
        else:
            for w in new:
                del self.index[w]
        if not words:
            return np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        return _drawn(lattices, words, counts, keys, self.vocab, self.seed)


def encode_texts(
    keys: list[int | None], texts: list[str | None], vocab: Vocabulary, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    return Segmenter(vocab, seed)(keys, texts)


def _drawn(
    lattices: list[tuple[int, Lattice]],
    words: list[int],
    counts: list[int],
    keys: list[int | None],
    vocab: Vocabulary,
    seed: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Draws the segmentation of every text, given as chunk numbers and chunks per text."""
    word = np.array(words, dtype=np.int64)
    rows = len(counts)
    row = np.repeat(np.arange(rows), counts)
    lengths = np.concatenate([x.lengths for _, x in lattices])
    length = lengths[word]
    stop = np.cumsum(length)
    of_row = np.bincount(row, weights=length, minlength=rows).astype(np.int64)
    position = stop - (np.cumsum(of_row) - of_row)[row]  # of the chunk's end in its text
    # 1 sets a null key apart from key 0
    key = np.array([(k or 0) & (2**64 - 1) for k in keys], dtype=np.uint64)
    null = np.array([k is None for k in keys], dtype=np.uint64)
    start = mixed(mixed(key + GOLDEN * (np.uint64(seed) + null)) + GOLDEN)

    order = np.argsort(word, kind="stable")  # equal chunks together: neighbours in the tables
    cuts = np.searchsorted(word[order], [first for first, _ in lattices] + [len(lengths)])
    who, piece = [], []
    n = np.zeros(len(word), dtype=np.int64)  # pieces of each chunk
    for (first, lattice), a, b in zip(lattices, cuts, cuts[1:], strict=False):
        token = order[a:b]
        node = lattice.first[word[token] - first] + length[token]
        begin, size = start[row[token]], length[token]
        back = np.zeros(len(token), dtype=np.int64)  # characters drawn so far
        end = position[token]
        step = 0
        while len(token):
            step += 1
            x = begin + (end - back).astype(np.uint64) * GOLDEN
            edge = lattice.draw(node, mixed(x) >> np.uint64(32))
            n[token] = step
            who.append((step, token))
            piece.append(lattice.piece[edge])
            node = lattice.source[edge]
            back = back + lattice.size[edge]
            on = back < size
            if not on.all():
                token, node, back = token[on], node[on], back[on]
                begin, size, end = begin[on], size[on], end[on]
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]), dtype=np.int64)
    for (step, own), ids in zip(who, piece, strict=True):
        out[ends[own] - step] = ids
    row_of_piece = np.repeat(row, n)
    spelt = np.flatnonzero(out < 0)
    if len(spelt):
        repeat = np.ones(len(out), dtype=np.int64)
        raw = [chr(-1 - int(c)).encode("utf-8", "surrogatepass") for c in out[spelt]]
        repeat[spelt] = [len(b) for b in raw]
        fill = np.repeat(out < 0, repeat)
        out = np.repeat(out, repeat)
        out[fill] = [vocab.byte_id[x] for b in raw for x in b]
        row_of_piece = np.repeat(row_of_piece, repeat)
    per_row = np.bincount(row_of_piece, minlength=rows)
    return out.astype(np.int32), np.cumsum(per_row)


def decode_ids(ids: list[int], vocab: Vocabulary) -> str:
    """The text of a list of ids, without the leading space that encoding puts there."""
    spelt = b"".join([vocab.bytes[i] for i in ids])
    return spelt.decode("utf-8", "surrogatepass").removeprefix(" ")


# ---- on Spark -----------------------------------------------------------------------------


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, column], names=[*batch.schema.names, name]
    )


def _schema(df: DataFrame, added: str) -> str:
    return ", ".join([f"`{c}` {t}" for c, t in df.dtypes] + [added])


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    into: str = "piece_ids",
    alpha: float = ALPHA,
    seed: int = SEED,
    path: str | None = None,
    lossless: str | None = None,
) -> DataFrame:
    """``docs`` with a sampled segmentation of each row's text, seeded by its key.

    ``lossless`` names a column that tells whether decoding the ids gives back the text.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(path, alpha)
        segment = Segmenter(vocab, seed)
        for batch in batches:
            texts_of_batch = batch[text].to_pylist()
            for at, n in text_slices(texts_of_batch, SLICE_CHARS):
                b, texts = batch.slice(at, n), texts_of_batch[at : at + n]
                ids, ends = segment(b[key].to_pylist(), texts)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                none = np.append([t is None for t in texts], False)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, mask=none) if none.any() else pa.array(offsets),
                    pa.array(ids),
                )
                out = _with_column(b, into, lists)
                if lossless:
                    same = [x == t for x, t in zip(_decoded(lists, vocab), texts, strict=True)]
                    out = _with_column(out, lossless, pa.array(same, type=pa.bool_()))
                yield out

    added = f"`{into}` array<int>" + (f", `{lossless}` boolean" if lossless else "")
    return docs.mapInArrow(run, _schema(docs, added))


def _decoded(lists: pa.ListArray, vocab: Vocabulary) -> Iterator[str | None]:
    """Texts of an array of id lists, one list at a time as Python numbers."""
    ids = lists.values.to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy(zero_copy_only=False)
    for i, valid in enumerate(lists.is_valid().to_pylist()):
        yield decode_ids(ids[ends[i] : ends[i + 1]].tolist(), vocab) if valid else None


def decode(
    docs: DataFrame, ids: str = "piece_ids", into: str = "decoded", path: str | None = None
) -> DataFrame:
    """``docs`` with the text of each row's ids."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(path)
        for b in batches:
            texts = list(_decoded(b[ids], vocab))
            yield _with_column(b, into, pa.array(texts, type=pa.string()))

    return docs.mapInArrow(run, _schema(docs, f"`{into}` string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document's sampled piece ids, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return encode(docs, lossless="lossless").select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        "lossless",
    )
