"""Best-fit packing of tokenised documents by a configuration linear program.

A document becomes its token ids and a closing id 0; only documents longer than a sequence are
cut, into full pieces and a last shorter one. The pieces are packed into as few sequences as
the method finds:

1. *Tokenise* in Arrow batches. Only (length, CRC-32 of the ids, ...) is kept per piece, with
   the piece's rank among those of its length in the task. The rows are written once.
2. *Histogram* of the lengths: at most ``capacity`` rows, the only thing the driver sees.
3. *Configuration LP* over the histogram: a variable per way of filling a sequence, a covering
   row per length. Multiplicative weights price the lengths - a length that lags behind the
   others in coverage gets dearer - and a knapsack dynamic program over the capacity finds the
   most valuable filling, for every length the best one holding it. Steps are rounded down to
   whole sequences; what rounding leaves is solved again, and the last few pieces go best-fit
   decreasing, on the histogram, into open sequences or new ones.
4. *Assignment*: counts per (task, length), summed over the tasks before, turn a piece's rank
   into its rank in the corpus; a table of slot ranges (its size follows the histogram, not the
   documents) gives its sequence and offset. No group of equal lengths meets in one task.

Defined cases: a null or empty text is the single id 0; repeated rows and null ids are packed as
rows of their own; other columns are ignored; an empty table packs into nothing.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import batch_slices, materialise, table

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END = b"\0\0\0\0"
ROUNDS = 24  # price updates in a pass over the histogram
RESOLVES = 120  # dynamic programs solved again inside a pass when lengths have run out
PASSES = 4  # over what rounding left
WORTH = 0.002  # share of the pieces below which what is left is not worth another pass
RATE = 2.0  # of the weights' exponents
SLACK = 0.002  # open share of a configuration that is taken after lengths have run out
KEPT = {"chunks": 400_000, "pieces": 300_000}  # in a generation of a Python worker's memory
KEPT_BYTES = 64  # the longest kept
SLICE_BYTES = 4_000_000  # of the texts that are tokenised together
GATHERED = 1_000_000  # chunks whose ids are put one after the other at once
# Signs between an ASCII letter and the end of a chunk; not ' (it opens contractions).
CLOSING = re.compile(rb"(?<=[a-zA-Z])[!-&(-/:-@\[-`{-~]+(?=\n|\Z)")
# Letters of ASCII and Latin-1 only: one word to the tokenizer, nothing in it to compose.
WORD = re.compile(rb"(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
WORDS_A_TEXT = 1000  # that are encoded as one text


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# ---- tokens -------------------------------------------------------------------------------


class Remembered:
    """What was found for keys seen lately: two generations, of which the older one is dropped
    when the younger is full, so that frequent keys stay and rare ones make room."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def missing(self, keys: list[bytes]) -> list[bytes]:
        """Of keys that are not in the younger generation those that are not known at all; the
        others are taken over."""
        out = []
        for k in keys:
            x = self.old.get(k)
            if x is None:
                out.append(k)
            else:
                self.young[k] = x
        return out

    def turn(self) -> None:
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}


class Tokens:
    """The tokenizer, and the ids of words met lately.

    ``plain`` has the same model for texts of ``WORD``s with spaces between: it leaves out the
    composing and the splitting pattern, which change nothing there. ``last`` tells the ids that
    end a word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Lowercase
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        self.plain = Tokenizer(model)  # shared, not a copy
        self.plain.normalizer = Lowercase()
        self.plain.pre_tokenizer = Sequence(
            [WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        suffix = getattr(model, "end_of_word_suffix", None)
        if suffix:
            self.last[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.chunks, self.pieces = Remembered(KEPT["chunks"]), Remembered(KEPT["pieces"])


def _tokens(held: dict[str, Tokens], path: str) -> Tokens:
    """What ``held`` has for this tokenizer, made if need be."""
    if path not in held:
        held[path] = Tokens(path)
    return held[path]


def _may_lower(text: str | None) -> bool:
    """Whether A-Z may be lower-cased before the tokenizer does it: it composes (NFC) first, so a
    letter and a mark that compose in lower case only must not meet that way, and no special
    token may come about."""
    if not text or "<|" in text:
        return False
    if text.isascii():
        return True
    lowered = text.encode("utf-8").lower().decode("utf-8")
    return is_normalized("NFC", text) and is_normalized("NFC", lowered)


def _pieces(chunks: list[bytes]) -> list[list[bytes]]:
    """Pieces of chunks between which the tokenizer always cuts: it does between a letter and a
    following sign, so the signs that close a chunk stand apart from it, and far fewer different
    pieces are left. A chunk that may hold a special token stays whole."""
    if not chunks:
        return []
    lines = CLOSING.sub(rb" \g<0>", b"\n".join(chunks)).split(b"\n")
    return [[c] if b"<|" in c else x.split(b" ") for c, x in zip(chunks, lines, strict=True)]


def _encode_words(state: Tokens, words: list[bytes]) -> list[bytes]:
    """Add the ids of new ``WORD``s, many in a text, to what the worker knows; those of a text
    in which not every word has its end are returned."""
    out = []
    for at in range(0, len(words), WORDS_A_TEXT):
        part = words[at : at + WORDS_A_TEXT]
        text = b" ".join(part).decode("utf-8")
        [encoded] = state.plain.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(encoded.ids, dtype="<u4")
        ends = (4 * (np.flatnonzero(state.last[ids]) + 1)).tolist()
        data = ids.tobytes()
        if len(ends) != len(part) or ends[-1] != len(data):
            out += part
            continue
        state.pieces.young.update(
            (w, data[a:b]) for w, a, b in zip(part, [0, *ends[:-1]], ends, strict=True)
        )
    return out


def _encode(state: Tokens, pieces: list[bytes]) -> None:
    """Add the ids of new pieces to what the worker knows."""
    words, whole = [], []
    for w in pieces:
        (words if WORD.fullmatch(w) else whole).append(w)
    whole += _encode_words(state, words)
    for at in range(0, len(whole), 20_000):
        part = whole[at : at + 20_000]
        encoded = state.tokenizer.encode_batch_fast(
            [w.decode("utf-8") for w in part], add_special_tokens=False
        )
        state.pieces.young.update(
            (w, array("I", e.ids).tobytes()) for w, e in zip(part, encoded, strict=True)
        )


def _chunk_ids(state: Tokens, chunks: list[bytes]) -> list[bytes]:
    """Ids of different chunks, most of them known to the worker."""
    state.chunks.turn()
    state.pieces.turn()
    known, ids_of = state.chunks.young, state.pieces.young
    data = list(map(known.get, chunks))
    gaps = [i for i, x in enumerate(data) if x is None]
    new = state.chunks.missing([chunks[i] for i in gaps])
    cut = _pieces(new)
    wanted = {p for own in cut for p in own}
    _encode(state, state.pieces.missing([p for p in wanted if p not in ids_of]))
    for c, own in zip(new, cut, strict=True):
        known[c] = ids_of[own[0]] if len(own) == 1 else b"".join([ids_of[p] for p in own])
    for i in gaps:
        data[i] = known[chunks[i]]
    for kept, keys in ((known, new), (ids_of, wanted)):
        for k in keys:
            if len(k) > KEPT_BYTES:
                del kept[k]
    return data


def token_bytes(
    texts: pa.Array | list[str | None], path: str, held: dict[str, Tokens] | None = None
) -> list[bytes]:
    """Each text's ids as little-endian 32-bit numbers, without the closing id. ``held`` keeps
    what is known from call to call.

    The tokenizer drops white space and never joins, composes or changes case across it (ASCII
    white space is a subset of what it drops), so a text's ids are those of the chunks between,
    one after the other. Arrow splits the texts and finds the different chunks; only these are
    looked up, and only those not met lately are encoded.
    """
    state = _tokens({} if held is None else held, path)
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, type=pa.string())
    lower = pa.array([_may_lower(t) for t in texts.to_pylist()], type=pa.bool_())
    texts = pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(pc.if_else(lower, pc.ascii_lower(texts), texts))
    coded = parts.flatten().dictionary_encode()
    # by way of numpy: a fraction of to_pylist's time
    chunks = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    data = _chunk_ids(state, chunks)
    sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) // 4
    first, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(data), dtype="<u4")
    codes = coded.indices.to_numpy()
    out = []
    for at in range(0, len(codes), GATHERED):
        own = codes[at : at + GATHERED]
        size = sizes[own]
        ends = np.cumsum(size)
        out.append(ids[np.arange(ends[-1]) + np.repeat(first[own] - (ends - size), size)].tobytes())
    joined = b"".join(out)
    # where each text's ids end: after those of its last chunk
    end_of = np.concatenate([[0], 4 * np.cumsum(sizes[codes])])
    ends = end_of[np.cumsum(pc.list_value_length(parts).to_numpy())].tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends, strict=False)]


PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, part_rank long"
)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """A row per piece; ``part_rank`` counts the pieces of a length within a task."""
    path = path or tokenizer_path()
    # A worker fills its copy and keeps it from task to task; Spark drops it there before the
    # first task that does not use this broadcast, so other operators' tasks have the room.
    held = docs.sparkSession.sparkContext.broadcast({})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        size = 4 * capacity
        for batch in batches:
            for slice_ in batch_slices(batch, "text", SLICE_BYTES):
                rows = []
                texts = token_bytes(slice_["text"], path, held.value)
                for doc_id, ids in zip(slice_["doc_id"].to_pylist(), texts, strict=True):
                    ids += END
                    for k in range(0, len(ids), size):
                        own = ids[k : k + size]
                        n = len(own) // 4
                        rows.append((doc_id, k // size, k // 4, n, zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                columns = list(zip(*rows, strict=True)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[i], type=pa.int32() if i in (1, 5) else pa.int64())
                        for i in range(7)
                    ],
                    names=[c.split()[0] for c in PIECES.split(", ")],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, PIECES)


# ---- configuration LP ---------------------------------------------------------------------


class Knapsack:
    """Best filling of every capacity, items of length l unlimited at price y_l."""

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, capacity: int):
        live = prices > 0
        self.lengths, prices = lengths[live], prices[live]
        self.value = np.zeros(capacity + 1)
        self.choice = np.full(capacity + 1, -1)
        ends = np.searchsorted(self.lengths, np.arange(capacity + 1), side="right")
        value, ls = self.value, self.lengths
        for c in range(1, capacity + 1):
            value[c] = value[c - 1]
            k = ends[c]
            if k:
                got = value[c - ls[:k]] + prices[:k]
                j = got.argmax()
                if got[j] > value[c]:
                    value[c], self.choice[c] = got[j], ls[j]

    def fill(self, room: int) -> list[int]:
        out = []
        while room > 0:
            l = int(self.choice[room])
            if l < 0:
                room -= 1  # nothing better than the next smaller capacity
            else:
                out.append(l)
                room -= l
        return out


def _lp_pass(
    lengths: np.ndarray, counts: np.ndarray, capacity: int
) -> tuple[Counter[tuple[int, ...]], np.ndarray]:
    """Whole sequences per configuration, and the counts that they leave."""
    at = {int(l): i for i, l in enumerate(lengths)}
    covered = np.zeros(len(lengths), dtype=np.int64)
    used: Counter[tuple[int, ...]] = Counter()
    resolves, spent = RESOLVES, False
    # Of every length a share is due in each round, whatever its count: the fractional parts are
    # spread over the rounds, so single pieces fall due one after the other and not all at last.
    phase = np.arange(len(lengths)) * 0.6180339887498949 % 1.0
    # the start of the dual: a length is worth its share of a sequence, long ones a little more
    worth = lengths + 0.5 * (lengths / capacity) ** 2
    for t in range(1, ROUNDS + 1):
        due = counts if t == ROUNDS else np.floor(counts * (t / ROUNDS) + phase).astype(np.int64)
        lag = t / ROUNDS - covered / counts
        prices = np.where(covered < counts, worth * np.exp(RATE * lag), 0.0)
        best = Knapsack(lengths, prices, capacity)
        for i in range(len(lengths) - 1, -1, -1):
            l = int(lengths[i])
            while True:
                need = int(min(due[i], counts[i]) - covered[i])
                if need < 1:
                    break
                own = Counter([l, *best.fill(capacity - l)])
                left = {k: int(counts[at[k]] - covered[at[k]]) for k in own}
                short = [k for k, a in own.items() if a > left[k]]
                if short:
                    spent = True
                    if resolves and any(left[k] == 0 for k in short):
                        resolves -= 1
                        prices[covered >= counts] = 0.0
                        best = Knapsack(lengths, prices, capacity)
                        continue
                    for k in short:
                        own[k] = left[k]
                    own += Counter()
                room = capacity - sum(k * a for k, a in own.items())
                if not own[l] or (spent and room > capacity * SLACK):
                    break  # prices no longer say what this length is worth: leave it to the rest
                step = min(max(1, need // own[l]), *(left[k] // a for k, a in own.items()))
                used[tuple(sorted(own.elements(), reverse=True))] += step
                for k, a in own.items():
                    covered[at[k]] += step * a
    return used, counts - covered


def _best_fit(
    groups: Counter[tuple[int, ...]], lengths: np.ndarray, counts: np.ndarray, capacity: int
) -> Counter[tuple[int, ...]]:
    """Best-fit decreasing of the left-over ``counts``, whole groups of sequences at a time."""
    by_room: dict[int, Counter[tuple[int, ...]]] = {}
    open_rooms = np.zeros(capacity + 1, dtype=bool)

    def put(config: tuple[int, ...], n: int) -> None:
        room = capacity - sum(config)
        by_room.setdefault(room, Counter())[config] += n
        open_rooms[room] = True

    for config, n in groups.items():
        put(config, n)
    for l, n in zip(lengths[::-1].tolist(), counts[::-1].tolist(), strict=True):
        while n:
            rooms = np.flatnonzero(open_rooms[l:])
            if len(rooms):
                room = l + int(rooms[0])
                config, have = next(iter(by_room[room].items()))
                step = min(n, have)
                if step == have:
                    del by_room[room][config]
                    open_rooms[room] = bool(by_room[room])
                else:
                    by_room[room][config] -= step
                put((*config, l), step)
                n -= step
            else:
                each = min(n, capacity // l)
                step = n // each
                put((l,) * each, step)
                n -= step * each
    out: Counter[tuple[int, ...]] = Counter()
    for own in by_room.values():
        out.update(own)
    return out


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> Counter[tuple[int, ...]]:
    """The heuristic alone, without the linear program."""
    lengths = sorted(l for l, n in histogram.items() if n > 0)
    counts = np.array([histogram[l] for l in lengths], dtype=np.int64)
    return _best_fit(Counter(), np.array(lengths, dtype=np.int64), counts, capacity)


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> Counter[tuple[int, ...]]:
    """Configurations (lengths in a sequence) and how many sequences are filled so.

    The linear program is rounded down to whole sequences, and what that leaves is solved again
    while it is worth a pass (``PASSES``, ``WORTH``); the last pieces go best-fit decreasing. On a
    few pieces rounding can cost more than the program gains, so the heuristic's answer is taken
    where it is better: never more sequences than best-fit decreasing.
    """
    groups: Counter[tuple[int, ...]] = Counter()
    left = {l: n for l, n in histogram.items() if n > 0}
    if left.get(capacity):
        groups[(capacity,)] = left.pop(capacity)
    total = sum(left.values())
    for _ in range(PASSES):
        if not left or sum(left.values()) < WORTH * total:
            break
        lengths = np.array(sorted(left), dtype=np.int64)
        used, rest = _lp_pass(lengths, np.array([left[l] for l in lengths.tolist()]), capacity)
        groups.update(used)
        left = {l: n for l, n in zip(lengths.tolist(), rest.tolist(), strict=True) if n}
    lengths = np.array(sorted(left), dtype=np.int64)
    counts = np.array([left[l] for l in lengths.tolist()], dtype=np.int64)
    programmed = _best_fit(groups, lengths, counts, capacity)
    plain = best_fit_decreasing(histogram, capacity)
    return programmed if sum(programmed.values()) <= sum(plain.values()) else plain


# ---- assignment ---------------------------------------------------------------------------


def slots(groups: Counter[tuple[int, ...]]) -> tuple[np.ndarray, ...]:
    """Ranges of ranks per length: (length, first rank, first sequence, offset), sorted."""
    taken: Counter[int] = Counter()
    rows, sequence = [], 0
    for config, n in sorted(groups.items(), reverse=True):
        offset = 0
        for l in config:
            rows.append((l, taken[l], sequence, offset))
            taken[l] += n
            offset += l
        sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return tuple(table.T)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    rows = materialise(pieces(docs, capacity, path), "packing-pieces")
    counts = materialise(
        rows.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts"
    )
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # <= capacity rows
    length, first, sequence, offset = slots(
        solve({r["length"]: r["n"] for r in histogram}, capacity)
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    # both sides follow the input (a start per task and length), so neither is broadcast
    ranked = rows.join(starts.hint("merge"), ["part", "length"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("before") + F.col("part_rank")).alias("rank"),
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one number per (length, rank): lengths in order, ranks in order within a length
        of_length = np.searchsorted(length, np.arange(capacity + 2))
        for b in batches:
            own = b["length"].to_numpy(zero_copy_only=False)
            rank = b["rank"].to_numpy(zero_copy_only=False)
            low, high = of_length[own], of_length[own + 1] - 1
            while (low < high).any():  # last slot range that starts at or before the rank
                mid = (low + high + 1) // 2
                right = first[mid] <= rank
                low, high = np.where(right, mid, low), np.where(right, high, mid - 1)
            yield pa.RecordBatch.from_arrays(
                [b[c] for c in kept]
                + [pa.array(sequence[low] + rank - first[low]), pa.array(offset[low])],
                names=[*kept, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every piece of every document, packed."""
    return pack(table(spark, sf_dir, "documents"))
