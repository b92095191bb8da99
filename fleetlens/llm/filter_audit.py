"""What every order of five filters removes, from a sparse document-term matrix.

Filters, by their failure conditions: A under ``MIN_WORDS`` words; B under ``DISTINCT`` percent
distinct words; C over ``CAPITALS`` percent letters A-Z; D any of ``SIGNS``; E a text that a
smaller doc_id has as well, anywhere in the table, removed or not.

* *Shards*: a task cuts its documents into runs of ``SHARD_BYTES`` of text and gives each run a
  row: its words (a dictionary of the run), and a matrix of its documents in compressed sparse
  rows (start of each document, word numbers in the run, occurrences, in as few bytes as they
  need), besides what the other filters need (capitals, signs, a SHA-256 of the text). The rows are
  written once.
* *Dictionary*: a run numbers its words bucket by bucket of their hash, and gives a row per (run,
  bucket) with its words there, so a frequent word is an entry per run, not a row per occurrence. A
  task numbers a bucket's words as they come; a word's number is its rank in the bucket plus the number
  of words in the buckets before. Nothing but the buckets' totals meets the driver.
* *Matrix*: the numbers go back to their runs and replace the run's own (``matrix``).
* *Decisions*: row sums are the documents' words, numbers of entries the distinct ones: A and B.
  The other flags are attached, the documents counted by (part, flags), and every order and
  step is arithmetic on at most 32 counts per part: with Z(S) the documents that no filter of S
  fails, a step from S to S + f keeps Z(S + f) and removes Z(S) - Z(S + f); the Shapley sum of a
  filter is the sum of |S|! (4 - |S|)! times what it removes after S.

Defined cases: a null text is empty, a null source the part ``''``; a null id is never a copy (and
never the smaller one) and has no labels; rows repeated with one id are each counted, and are no
copies of each other; an id labelled more than once counts as 1 if any of its labels is; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import batch_slices, materialise, table

# Fixed values of the contract.
FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT = 65
CAPITALS = 5
SIGNS = b"#$%&*|"

SHARD_BYTES = 2_000_000
MAX_BUCKETS = 4_096  # of words: a bucket's words are held by one task at a time

_NOT_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_SIGNS = bytes(c for c in range(256) if c not in SIGNS)

_SHARD_TYPES = [
    ("shard", pa.int64(), "long"),
    ("doc_id", pa.list_(pa.int64()), "array<long>"),
    ("part", pa.list_(pa.string()), "array<string>"),
    ("capitals", pa.list_(pa.bool_()), "array<boolean>"),
    ("signs", pa.list_(pa.bool_()), "array<boolean>"),
    ("digest", pa.list_(pa.binary()), "array<binary>"),
    ("indptr", pa.binary(), "binary"),  # int32
    ("indices", pa.binary(), "binary"),  # unsigned; the run's own numbers
    ("counts", pa.binary(), "binary"),  # unsigned
    ("words", pa.binary(), "binary"),  # one a line, in the order of their numbers
    ("starts", pa.binary(), "binary"),  # int32; the first number of every bucket, and the last's end
]
_PER_DOCUMENT = ["doc_id", "part", "capitals", "signs", "digest"]


def _schema(types: list[tuple[str, pa.DataType, str]]) -> str:
    return ", ".join(f"{name} {spark}" for name, _, spark in types)


def _one(values: object, kind: pa.DataType) -> pa.Array:
    """A list column with the one row ``values``."""
    flat = pa.array(values, type=kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], type=pa.int32()), flat)


def _narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 in the fewest bytes that hold the largest."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def numbers(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_narrow``."""
    width = len(data) // n if n else 1
    return np.frombuffer(data, dtype=f"<u{width}").astype(np.int64)


# ---- shards -------------------------------------------------------------------------------


def shard_row(shard: int, part: pa.RecordBatch, n_buckets: int) -> pa.RecordBatch:
    """The matrix and the flags' inputs of a run of documents, as one row."""
    own: dict[bytes, int] = defaultdict(count().__next__)
    indptr, indices, counts = array("i", [0]), array("i"), array("i")
    capitals, signs, digests = [], [], []
    for text in part["text"].to_pylist():
        data = (text or "").encode("utf-8")
        words = Counter(data.split())  # of bytes: splits at ASCII white space and nothing else
        indices.extend(map(own.__getitem__, words))
        counts.extend(words.values())
        indptr.append(len(indices))
        capitals.append(100 * len(data.translate(None, _NOT_CAPITALS)) > CAPITALS * len(text or ""))
        signs.append(len(data.translate(None, _NOT_SIGNS)) > 0)
        digests.append(hashlib.sha256(data).digest())
    # renumbered by bucket, so that a bucket's words are a range of numbers
    bucket = np.fromiter(map(zlib.crc32, own), dtype=np.int64, count=len(own)) % n_buckets
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(own), dtype=np.int32)
    number[order] = np.arange(len(own))
    starts = np.searchsorted(bucket[order], np.arange(n_buckets + 1)).astype(np.int32)
    words = list(own)
    lists = [part["doc_id"], part["part"], capitals, signs, digests]
    columns = [_one(x, kind) for x, (_, kind, _) in zip(lists, _SHARD_TYPES[1:], strict=False)]
    blobs = [
        indptr.tobytes(),
        _narrow(number[np.frombuffer(indices, dtype=np.int32)]),
        _narrow(np.frombuffer(counts, dtype=np.int32)),
        b"\n".join([words[i] for i in order.tolist()]),
        starts.tobytes(),
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], type=pa.int64()),
            *columns,
            *[pa.array([x], type=pa.binary()) for x in blobs],
        ],
        names=[name for name, _, _ in _SHARD_TYPES],
    )


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row per run of documents; word numbers are the run's own."""
    n_buckets = buckets_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        for b in batches:
            for part in batch_slices(b, "text", shard_bytes):
                yield shard_row(next(number), part, n_buckets)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    )
    return rows.mapInArrow(run, _schema(_SHARD_TYPES))


# ---- dictionary and matrix ----------------------------------------------------------------


_ENTRY = "bucket int, shard long, words binary"
_CODE = "bucket int, shard long, ranks binary, n_ranks int, n long"


def buckets_of(spark: SparkSession) -> int:
    """Buckets of the words: some for every task of a shuffle, ``MAX_BUCKETS`` at most."""
    return min(MAX_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _by_bucket(runs: DataFrame) -> DataFrame:
    """The runs' words by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, data, starts in zip(*(b[c].to_pylist() for c in ("shard", "words", "starts")), strict=True):
                words = data.split(b"\n")
                at = np.frombuffer(starts, dtype=np.int32)
                found = np.flatnonzero(np.diff(at))
                own = [b"\n".join(words[at[k] : at[k + 1]]) for k in found.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found, type=pa.int32()),
                        pa.array([shard] * len(found), type=pa.int64()),
                        pa.array(own, type=pa.binary()),
                    ],
                    names=[c.split()[0] for c in _ENTRY.split(", ")],
                )

    return runs.select("shard", "words", "starts").mapInArrow(run, _ENTRY)


def dictionary(runs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``bucket, shard, ranks, n_ranks`` of the runs' words, and the words before each bucket.

    The number of a word is ``before[bucket]`` plus its rank: the same in every run, different
    for every word, and without gaps.
    """
    n_buckets = buckets_of(runs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known = None, defaultdict(count().__next__)
        for b in batches:
            ranks, sizes, seen = [], [], []
            for bucket, data in zip(b["bucket"].to_pylist(), b["words"].to_pylist(), strict=True):
                if bucket != now:
                    now, known = bucket, defaultdict(count().__next__)
                words = data.split(b"\n")
                ranks.append(_narrow(np.fromiter(map(known.__getitem__, words), np.int64, len(words))))
                sizes.append(len(words))
                seen.append(len(known))
            yield pa.RecordBatch.from_arrays(
                [
                    b["bucket"],
                    b["shard"],
                    pa.array(ranks, type=pa.binary()),
                    pa.array(sizes, type=pa.int32()),
                    pa.array(seen, type=pa.int64()),
                ],
                names=[c.split()[0] for c in _CODE.split(", ")],
            )

    dealt = _by_bucket(runs).repartition("bucket").sortWithinPartitions("bucket", "shard")
    codes = materialise(dealt.mapInArrow(run, _CODE), "audit-dictionary")
    size = np.zeros(n_buckets + 1, dtype=np.int64)
    for r in codes.groupBy("bucket").agg(F.max("n").alias("n")).collect():  # at most n_buckets
        size[r["bucket"] + 1] = r["n"]
    return codes.drop("n"), np.cumsum(size)


_MATRIX_TYPES = [("indices", pa.binary(), "binary") if x[0] == "indices" else x for x in _SHARD_TYPES[:-2]]


def matrix(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """CSR shards over the whole corpus's words, and the number of words (columns).

    Per shard: ``doc_id``, ``part``, ``capitals``, ``signs``, ``digest`` by document, and the
    little-endian arrays ``indptr`` (int32), ``indices`` (int64, numbers in the corpus's
    dictionary) and ``counts`` (see ``numbers``).
    """
    runs = materialise(shards(docs, shard_bytes), "audit-shards")
    codes, before = dictionary(runs)
    per_shard = codes.groupBy("shard").agg(
        F.collect_list(F.struct("bucket", "ranks", "n_ranks")).alias("entries")
    )
    joined = runs.drop("words").join(per_shard, "shard", "left")
    names = [name for name, _, _ in _MATRIX_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                starts = np.frombuffer(row["starts"][0].as_py(), dtype=np.int32)
                number = np.zeros(int(starts[-1]), dtype=np.int64)
                for e in row["entries"][0].as_py() or []:
                    own = slice(starts[e["bucket"]], starts[e["bucket"] + 1])
                    number[own] = before[e["bucket"]] + numbers(e["ranks"], e["n_ranks"])
                nnz = int(np.frombuffer(row["indptr"][0].as_py(), dtype=np.int32)[-1])
                local = numbers(row["indices"][0].as_py(), nnz)
                indices = pa.array([number[local].tobytes()], type=pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [indices if name == "indices" else row[name] for name in names], names=names
                )

    return joined.mapInArrow(run, _schema(_MATRIX_TYPES)), int(before[-1])


# ---- decisions ----------------------------------------------------------------------------


def measures(shards_: DataFrame) -> DataFrame:
    """Per document: ``n_words`` (row sum), ``n_distinct`` (entries) and the flags' inputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                start = np.frombuffer(row["indptr"][0].as_py(), dtype=np.int32)
                counts = numbers(row["counts"][0].as_py(), int(start[-1]))
                total = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *[row[c].flatten() for c in _PER_DOCUMENT],
                        pa.array(np.diff(total[start]), type=pa.int64()),
                        pa.array(np.diff(start).astype(np.int64)),
                    ],
                    names=[*_PER_DOCUMENT, "n_words", "n_distinct"],
                )

    return shards_.mapInArrow(
        run,
        "doc_id long, part string, capitals boolean, signs boolean, digest binary, "
        "n_words long, n_distinct long",
    )


def flags(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask``: bit i of the mask is set if filter i of ``FILTERS`` fails."""
    rows = materialise(measures(matrix(docs)[0]), "audit-measures")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    fails = [
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < DISTINCT * F.col("n_words"),
        F.col("capitals"),
        F.col("signs"),
        F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)),
    ]
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0))
    return rows.join(first, "digest").select("doc_id", "part", mask.alias("mask"))


def _steps() -> str:
    """The orders' steps: the filter's bit and the filters before it, as JSON."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            name = "".join(FILTERS[i] for i in order)
            out.append({"filter_order": name, "step": step, "f": f, "before": before})
            before |= 1 << f
    return json.dumps(out)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step."""
    n = len(FILTERS)
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .groupBy("doc_id")
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("bad"),
        )
    )
    cells = (
        flags(docs)
        .join(marks, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )

    def passing(what: str) -> str:  # at place S: the documents that no filter of S fails
        sums = (f"coalesce(sum(if((mask & {s}) = 0, {what}, 0)), 0L)" for s in range(1 << n))
        return f"array({', '.join(sums)})"

    parts = cells.groupBy("part").agg(
        F.expr(passing("n")).alias("z"),
        F.expr(passing("good")).alias("z_good"),
        F.expr(passing("bad")).alias("z_bad"),
    )

    def shapley(f: int) -> str:
        rest = [s for s in range(1 << n) if not s >> f & 1]
        terms = (
            f"{factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())}L * (z[{s}] - z[{s | 1 << f}])"
            for s in rest
        )
        return " + ".join(terms)

    steps = F.from_json(
        F.lit(_steps()), "array<struct<filter_order: string, step: int, f: int, before: int>>"
    )
    rows = parts.withColumn(
        "shares", F.expr(f"array({', '.join(shapley(f) for f in range(n))})")
    ).select("*", F.inline(steps))
    rows = rows.withColumn("after", F.expr("before | shiftleft(1, f)"))
    rows = rows.withColumn("removed", F.expr("z[before] - z[after]"))
    return rows.selectExpr(
        "part",
        "filter_order",
        "step",
        "z[after] AS kept",
        "removed",
        "z[0] - z[shiftleft(1, f)] - removed AS redundant",
        f"z[{(1 << n) - 1} - shiftleft(1, f)] - z[{(1 << n) - 1}] AS unique_fails",
        "z_good[before] - z_good[after] AS good_lost",
        "z_bad[before] - z_bad[after] AS toxic_lost",
        "shares[f] AS shapley",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every order of the filters over all documents."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
        min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
f AS (SELECT w.part,
        list_filter([
          CASE WHEN len(words) < 50 THEN 'A' END,
          CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
          CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' END,
          CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
          CASE WHEN first < w.doc_id THEN 'E' END], lambda x: x IS NOT NULL) AS failing,
        coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, failing, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT part, o, i AS step, o[i] AS x, n, good, bad, failing FROM c, o, range(1, 6) r(i)),
t AS (SELECT *, list_has_any(failing, o[1:step - 1]) AS gone, list_contains(failing, x) AS hit FROM s),
g AS (SELECT part, array_to_string(o, '') AS filter_order, CAST(step AS INT) AS step, x,
        CAST(sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN hit AND len(failing) = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN NOT gone AND hit THEN bad ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM t GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM g"""
