"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over ``WINDOW`` bytes runs along the whole UTF-8 text; where it hits a trigger
value for a block size, a piece ends. Boundaries depend on their near context only, so an edit
changes the pieces it touches and no others. A piece becomes ``PIECE_CHARS`` base-64 characters
of its hash. Block sizes are powers of two times ``SMALLEST``; a text takes the smallest one
that gives fewer than ``PIECES`` triggers, and its signature holds the pieces at that size and
at twice that size (the larger size's triggers are among the smaller one's), so no text is
ever cut to fit. Written ``size:pieces:pieces``.

Two fingerprints are compared at compatible block sizes - the same, or one twice the other - by
edit distance (insertions and deletions) over pieces: likeness = 1 - distance / pieces of both.
Equal fingerprints have likeness 1; without a compatible size it is 0.

``op8`` also fingerprints every document's edited text, whose end comes from the next document
in the order of ids. Documents are dealt by ranges of ids, texts compressed for the way; a task
meets its documents in order and needs one beyond its range: the last of a task and the first
of the next are joined in a small second pass. No order over all documents is ever built in one
task.

Defined cases: a null text is an empty one; an empty text has the fingerprint of one empty
piece; documents without an id come first (nulls first), rows with equal ids follow each other
in the order of their texts; the only document's next is itself; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import materialise, table

WINDOW = 7
SMALLEST = 4
PIECES = 64
PIECE_CHARS = 2
FACTOR = 0x2545F491  # odd multiplier of the rolling hash
CHUNK = 1 << 20  # bytes hashed at a time
SEED = 8
# the 64 characters of the usual base-64 alphabet
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PAIRS = [a + b for a in ALPHABET for b in ALPHABET]


# ---- fingerprints -------------------------------------------------------------------------


def _levels(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions after trigger bytes, and at how many doublings of the size each still triggers.

    The rolling hash of a position is a polynomial in its last ``WINDOW`` bytes, mixed so that
    its low zero bits are well spread; size SMALLEST * 2^k triggers where the lowest
    log2(SMALLEST) + k bits are zero.
    """
    powers = [pow(FACTOR, k, 1 << 32) for k in range(WINDOW)]
    places, levels = [], []
    least = SMALLEST.bit_length() - 1
    for at in range(0, len(data), CHUNK):
        n = min(CHUNK, len(data) - at)
        x = np.zeros(n + WINDOW - 1, dtype=np.uint32)  # zeros stand before the text
        back = min(at, WINDOW - 1)
        x[WINDOW - 1 - back :] = np.frombuffer(
            data, dtype=np.uint8, count=n + back, offset=at - back
        )
        x += np.uint32(1)
        h = np.zeros(n, dtype=np.uint32)
        for k in range(WINDOW):
            h += x[WINDOW - 1 - k : len(x) - k] * np.uint32(powers[k])
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)  # the usual 32-bit finaliser's first multiplier
        h ^= h >> np.uint32(13)
        hit = np.flatnonzero((h & np.uint32(SMALLEST - 1)) == 0)
        low = h[hit]
        zeros = np.bitwise_count((low & (~low + np.uint32(1))) - np.uint32(1))  # 32 for 0
        places.append(hit + at + 1)
        levels.append(zeros.astype(np.int64) - least)
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(levels)


def _pieces(data: bytes, ends: list[int]) -> str:
    digest = xxhash.xxh3_64_intdigest
    last = len(data)
    if not ends or ends[-1] < last or not last:
        ends = [*ends, last]
    out, start = [], 0
    for end in ends:
        out.append(PAIRS[digest(data[start:end], SEED) & 4095])
        start = end
    return "".join(out)


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    places, levels = _levels(data)
    counts = np.bincount(np.clip(levels, 0, 40), minlength=42)
    at_least = counts[::-1].cumsum()[::-1]  # triggers at k doublings or more
    k = int(np.flatnonzero(at_least < PIECES)[0])
    one = places[levels >= k].tolist()
    two = places[levels >= k + 1].tolist()
    return f"{SMALLEST << k}:{_pieces(data, one)}:{_pieces(data, two)}"


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _split(pieces: str) -> list[str]:
    return [pieces[i : i + PIECE_CHARS] for i in range(0, len(pieces), PIECE_CHARS)]


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if one == other:
        return 1.0
    size_a, a1, a2 = one.split(":")
    size_b, b1, b2 = other.split(":")
    x, y = int(size_a), int(size_b)
    if x == y:
        pairs = [(a1, b1), (a2, b2)]
    elif x == 2 * y:
        pairs = [(a1, b2)]
    elif y == 2 * x:
        pairs = [(a2, b1)]
    else:
        return 0.0
    best = 0.0
    for a, b in pairs:
        pa_, pb = _split(a), _split(b)
        best = max(best, 2 * _common(pa_, pb) / (len(pa_) + len(pb)))
    return best


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


# ---- in the order of ids ------------------------------------------------------------------

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _row(doc_id, text: str, own: str, following: str, next_fp: str) -> tuple:
    changed = edited(text, following)
    changed_fp = own if changed == text else fingerprint(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        own,
        changed_fp,
        likeness(own, changed_fp),
        likeness(own, next_fp),
    )


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names
    )


TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
EDGES = ["part", "last", "doc_id", "packed", "fp"]
EDGE_TYPES = [pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.string()]


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = [
                press.compress((t or "").encode("utf-8", "surrogatepass"))
                for t in b["text"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(texts, type=pa.binary())], names=["doc_id", "packed"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, packed binary")


def _ranges(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """For every document its fingerprint, its edited text's, and their likenesses."""
    spark = docs.sparkSession
    ordered = (
        _packed(docs)
        .repartitionByRange(_ranges(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("packed"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("packed"), "packed")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        unpress = zstandard.ZstdDecompressor()
        held = None  # the document whose next has not come yet
        none = [None] * len(NAMES)
        kinds = [*TYPES, *EDGE_TYPES]
        names = [*NAMES, *[f"e_{c}" for c in EDGES]]
        no_edge = [None] * len(EDGES)
        for b in batches:
            rows = []
            for doc_id, packed in zip(
                b["doc_id"].to_pylist(), b["packed"].to_pylist(), strict=True
            ):
                text = unpress.decompress(packed).decode("utf-8", "surrogatepass")
                fp = fingerprint(text)
                if held is None:
                    rows.append((*none, part, False, doc_id, packed, fp))
                else:
                    rows.append((*_row(held[0], held[1], held[3], text, fp), *no_edge))
                held = (doc_id, text, packed, fp)
            yield _table(rows, names, kinds)
        if held is not None:
            yield _table([(*none, part, True, held[0], held[2], held[3])], names, kinds)

    schema = RESULT + ", e_part int, e_last boolean, e_doc_id long, e_packed binary, e_fp string"
    walked = materialise(ordered.mapInArrow(run, schema), "cth-walk")
    inner = walked.filter("e_part IS NULL").select(*NAMES)

    # two rows per range: each last document meets the first one of the next range that has any
    edges = walked.filter("e_part IS NOT NULL")
    parts = edges.filter("NOT e_last").select("e_part")
    order = Window.orderBy("e_part")  # one small number per range
    following = parts.select(
        "e_part",
        F.coalesce(F.lead("e_part").over(order), F.first("e_part").over(order)).alias("next_part"),
    )
    first = edges.filter("NOT e_last").select(
        F.col("e_part").alias("next_part"),
        F.col("e_packed").alias("next_packed"),
        F.col("e_fp").alias("next_fp"),
    )
    pairs = edges.filter("e_last").join(following, "e_part").join(first, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()

        def text(x: bytes) -> str:
            return unpress.decompress(x).decode("utf-8", "surrogatepass")

        for b in batches:
            rows = [
                _row(r["e_doc_id"], text(r["e_packed"]), r["e_fp"], text(r["next_packed"]), r["next_fp"])
                for r in b.to_pylist()
            ]
            yield _table(rows, NAMES, TYPES)

    ends = pairs.select("e_doc_id", "e_packed", "e_fp", "next_packed", "next_fp")
    return inner.unionByName(ends.mapInArrow(finish, RESULT))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document, where no neighbour is needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(fps, type=pa.string())], names=["doc_id", "fingerprint"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document against its edited text and the next document."""
    return compare_with_next(table(spark, sf_dir, "documents"))
