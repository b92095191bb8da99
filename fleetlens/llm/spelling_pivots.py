"""Spelling variants of corpus words: words one edit apart, found by pivotal grams.

* *Words*: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the whole texts with A-Z in lower case. A
  run whose crc32 of ``<doc_id>:<run>`` is divisible by ``NOISE`` loses the code point at crc32 %
  length. Kept are results of ``MIN_CHARS`` code points that occur ``MIN_COUNT`` times.
  Counted per task in bounded dictionaries, so a frequent word is a few rows, not one each.
* *Order*: bigrams from rare to frequent, by the number of kept words' places that hold them. The
  alphabet has 26 + 64 letters, so there are ``MAX_GRAMS`` = 8,100 bigrams at most, whatever the
  corpus; only this table goes through the driver.
* *Prefix*: a word's three rarest bigram places (and further places of the third one's bigram).
  *Pivots*: of these, two that share no letter and have the least total frequency, by dynamic
  programming over the places. One edit breaks one of two disjoint bigrams at most. Of two near
  words r and s let the third bigram of r be no later in the order (``last(r) <= last(s)``): a
  pivot of r that is whole in s is then in the prefix of s.
* *Index and probe*: with a whole pivot, the edit is right of it (then all up to the pivot is the
  same in both words, at the same place) or left of it (all from the pivot on is the same, at
  the same distance from the end); and in the part beyond, one half is the same. So the index
  holds, for every prefix place and side, the word's length, the place and what is the same for
  either half, as one 64-bit hash; a pivot probes for lengths one less, equal and one more. The
  hashes meet in an equi-join that adaptive execution can split, and a candidate pair is
  verified by Levenshtein distance.
* *Forms*: a word's form is its near word of largest count (ties: smallest in code-point order)
  if that has ``FORM_RATIO`` times its own; following forms (pointer jumping; every step
  multiplies the count, so chains are short) ends in its root.

Defined cases: a null text has no words; a null id enters the hashed name as an empty string;
repeated rows count again; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import materialise, table

# Fixed values of the contract.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOISE = 199
MIN_CHARS = 6
MIN_COUNT = 5
FORM_RATIO = 5

Q = 2  # letters of a gram
EDITS = 1
PREFIX = Q * EDITS + 1
MAX_GRAMS = (26 + 64) ** Q
FLUSH_WORDS = 300_000  # entries of a task's dictionary before they are given out


# ---- words --------------------------------------------------------------------------------


def text_words(doc_id: int | None, text: str | None, min_chars: int = MIN_CHARS) -> Counter[str]:
    """Words of a text and how often they occur, noise applied; shorter ones left out."""
    lowered = (text or "").encode("utf-8").lower().decode("utf-8")  # bytes: A-Z only
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode("utf-8"), start)
        if h % NOISE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= min_chars:
            out[run] += n
    return out


def corpus_words(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that occur ``min_count`` times in all."""

    def rows(own: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(own.keys(), type=pa.string()), pa.array(own.values(), type=pa.int64())],
            names=["word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter[str] = Counter()
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                own.update(text_words(doc_id.as_py(), text.as_py()))
                if len(own) >= FLUSH_WORDS:
                    yield rows(own)
                    own.clear()
        yield rows(own)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word")
    return counted.agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---- grams --------------------------------------------------------------------------------


def grams(word: str) -> list[str]:
    return [word[i : i + Q] for i in range(len(word) - Q + 1)]


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Places of the words that hold each bigram: at most ``MAX_GRAMS`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter[str] = Counter()
        for b in batches:
            for word in b["word"].to_pylist():
                own.update(grams(word))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.keys(), type=pa.string()), pa.array(own.values(), type=pa.int64())],
            names=["gram", "n"],
        )

    rows = words.select("word").mapInArrow(run, "gram string, n long")
    counted = rows.groupBy("gram").agg(F.sum("n").alias("n")).collect()
    if len(counted) > MAX_GRAMS:
        raise ValueError(f"{len(counted)} bigrams, more than the alphabet allows")
    return {r["gram"]: r["n"] for r in counted}


def ranked(counts: dict[str, int]) -> dict[str, tuple[int, int]]:
    """Rank (rare first) and count of every bigram."""
    order = sorted(counts.items(), key=lambda x: (x[1], x[0]))
    return {g: (rank, n) for rank, (g, n) in enumerate(order)}


def prefix_of(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """(place, count) of the word's rarest bigrams in order of place, and the last one's rank."""
    own = sorted((order[g][0], i, order[g][1]) for i, g in enumerate(grams(word)))
    last = own[min(PREFIX, len(own)) - 1][0]
    return sorted((i, n) for rank, i, n in own if rank <= last), last


def pivots_of(places: list[tuple[int, int]]) -> list[int]:
    """Places of ``EDITS + 1`` bigrams without a common letter, of least total count."""
    # best[k]: (cost, places) of k chosen so far, by the end of the last chosen one
    best: list[list[tuple[int, list[int]]]] = [[(0, [])]] + [[] for _ in range(EDITS + 1)]
    for i, n in places:
        for k in range(EDITS + 1, 0, -1):
            free = [x for x in best[k - 1] if not x[1] or x[1][-1] + Q <= i]
            if free:
                cost, chosen = min(free)
                best[k].append((cost + n, [*chosen, i]))
    return min(best[EDITS + 1])[1]


# What is the same in two words with one edit beside a whole gram. `at` is the gram's place and
# `size` the length in the indexed word; `mid` halves what is left or right of the gram there.


def index_keys(word: str, places: list[int]) -> Iterator[str]:
    size = len(word)
    for at in places:
        mid = at + Q + (size - at - Q) // 2
        yield f"0 {size} {at} {word[:mid]}"
        yield f"1 {size} {at} {word[: at + Q]} {word[mid:]}"
        mid = at // 2
        yield f"2 {size} {at} {word[:mid]} {word[at:]}"
        yield f"3 {size} {at} {word[mid:]}"


def probe_keys(word: str, places: list[int]) -> Iterator[str]:
    own = len(word)
    for place in places:
        for size in (own - 1, own, own + 1):
            at, shift = place, own - size
            if at + Q <= size:  # the edit is right of the gram
                mid = at + Q + (size - at - Q) // 2
                yield f"0 {size} {at} {word[:mid]}"
                yield f"1 {size} {at} {word[: at + Q]} {word[mid + shift :]}"
            at = place - shift
            if at >= 0:  # left of it
                mid = at // 2
                yield f"2 {size} {at} {word[:mid]} {word[place:]}"
                yield f"3 {size} {at} {word[mid + shift :]}" if mid + shift >= 0 else ""


def _keys(words: DataFrame, order: dict[str, tuple[int, int]], probe: bool) -> DataFrame:
    """``key, word, last``, a row per index or probe key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for b in batches:
            keys, own, lasts = [], [], []
            for word in b["word"].to_pylist():
                places, last = prefix_of(word, order)
                if probe:
                    found = probe_keys(word, pivots_of(places))
                else:
                    found = index_keys(word, [i for i, _ in places])
                hashes = {xxh64_intdigest(k) - (1 << 63) for k in found if k}
                keys += hashes
                own += [word] * len(hashes)
                lasts += [last] * len(hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, type=pa.int64()),
                    pa.array(own, type=pa.string()),
                    pa.array(lasts, type=pa.int32()),
                ],
                names=["key", "word", "last"],
            )

    return words.select("word").mapInArrow(run, "key long, word string, last int")


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: every pair of words (once, a < b) that are exactly one edit apart."""
    order = ranked(gram_counts(words))
    probes = _keys(words, order, probe=True).toDF("key", "r", "last_r")
    index = _keys(words, order, probe=False).toDF("key", "s", "last_s")
    found = probes.join(index, "key").filter(
        (F.col("last_r") <= F.col("last_s"))
        & (F.col("r") != F.col("s"))
        & (F.levenshtein("r", "s", EDITS) == EDITS)
    )
    return found.select(F.least("r", "s").alias("a"), F.greatest("r", "s").alias("b")).distinct()


# ---- forms --------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the ends of the chains ``word -> form``, by pointer jumping."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left").select(
            "word",
            F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("more"),
        )
        step = materialise(moved, "spelling-roots")
        now = step.select("word", "root")
        if step.filter("more").isEmpty():
            return now


def variants(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus."""
    words = materialise(corpus_words(docs, min_count), "spelling-words")
    pairs = materialise(near_pairs(words), "spelling-pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        both.join(counts, "near")
        .groupBy("word")
        .agg(
            F.count("*").alias("n_near"),
            F.max("near_n").alias("most"),
            F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first"),
        )
        .select("word", "n_near", "most", F.col("first.near").alias("nearest"))
    )
    is_form = F.col("most") >= FORM_RATIO * F.col("n")
    rows = materialise(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("nearest")).alias("form"),
            F.when(is_form, F.col("most")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every word's near words, form and root."""
    return variants(table(spark, sf_dir, "documents"))
