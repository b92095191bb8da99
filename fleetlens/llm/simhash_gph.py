"""SimHash near-duplicate detection by the general pigeonhole principle.

Documents get 64-bit SimHash fingerprints over word shingles. Fingerprints at ``max_bits`` or
fewer differing bits are linked, exactly:

1. *Fingerprints* are computed per document in Arrow batches and written once. From here on
   only distinct fingerprints are searched, so a group of exact copies is one row.
2. *Partition*: a 64 x 64 co-occurrence count of the set bits, over all distinct fingerprints,
   gives the bit correlations; correlated bits are put into the same part, which leaves the
   other parts more selective.
3. *Allocation*: thresholds T_i with sum(T_i) = max_bits - parts + 1 (T_i = -1 drops a part)
   guarantee that a linked pair is within T_i on some part. Candidate pairs of a part are
   counted from the whole histogram of its values (extrapolated to T_i > 0 by the bits' odds of
   differing); a dynamic program picks the cheapest thresholds, over 2 to 4 parts. Every choice
   finds every link; only the work differs.
4. *Probe and verify*: each fingerprint emits its part values, and their neighbours within T_i.
   Rows with one value form a bucket; a bucket over ``block_rows`` rows is cut into blocks, and
   every pair of blocks is a group of its own, so no task holds an unbounded bucket. Groups are
   sorted and streamed; distances are checked on all 64 bits, and a group reports a spanning
   forest of its links instead of all of its pairs.
5. *Components* by star rounds over the links (see ``components``).

Defined cases: a null, empty or blank text has fingerprint zero and links like any other; a
text of fewer words than a shingle is one shingle; a null ``doc_id`` is ignored when the
smallest id of a component is taken (a component of null ids only has a null id); repeated
rows are repeated in the result; other columns are ignored by ``near_duplicates`` and carried
by ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import materialise, table
from fleetlens.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
MAX_BITS = 3
BLOCK_ROWS = 2048
CHUNK = 1 << 16  # shingles whose bits are unpacked at a time
# Relative cost of emitting and sorting one probe row against checking one candidate pair.
PROBE_COST = 200.0


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and space with U+0009..U+000D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    digest = xxhash.xxh64_digest
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), CHUNK):
        raw = b"".join([digest(s, SEED) for s in shingles[at : at + CHUNK]])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *carried: Column) -> DataFrame:
    """``doc_id``, ``fp`` (a signed long), and the ``carried`` columns, for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], dtype=np.uint64)
            columns = [b[c] for c in kept] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "fp"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in kept) + ", fp long")


# ---- partition and allocation -------------------------------------------------------------


def _cooccurrence(distinct: DataFrame) -> tuple[np.ndarray, int]:
    """How often bits i and j are both set (64 x 64 numbers), over all distinct fingerprints."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            x = ((fps[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
            total += x.T @ x
            n += len(fps)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(BITS * BITS + 1, dtype=np.int32)),
                    pa.array(np.append(total.ravel(), n).astype(np.int64)),
                ],
                names=["cell", "n"],
            )

    cells = distinct.select("fp").mapInArrow(partial, "cell int, n long").groupBy("cell")
    out = np.zeros(BITS * BITS + 1)
    for cell, n in cells.agg(F.sum("n").alias("n")).collect():  # 4,097 rows at any size
        out[cell] = n
    return out[:-1].reshape(BITS, BITS), int(out[-1])


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of equal size, each grown around the most correlated ones."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.clip(p * (1 - p), 1e-9, None))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def _bits_mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _part_pairs(distinct: DataFrame, masks: list[int]) -> list[float]:
    """Pairs of distinct fingerprints that agree on each mask, from whole histograms."""
    ids = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("part"),
                    F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("value"),
                )
                for i, m in enumerate(masks)
            ]
        )
    )
    counts = (
        distinct.select(ids.alias("s")).groupBy("s.part", "s.value").agg(F.count("*").alias("n"))
    )
    n = F.col("n").cast("double")
    pairs = dict(counts.groupBy("part").agg(F.sum(n * (n - 1) / 2)).collect())
    return [float(pairs.get(i, 0.0)) for i in range(len(masks))]


def allocate(costs: list[list[float]], tau: int) -> tuple[float, list[int]]:
    """Thresholds T (``costs[i][t + 1]`` for T_i = t) with sum(T + 1) = tau + 1, least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for extra, more in enumerate(row):
                key = used + extra
                if key <= tau + 1 and (key not in step or cost + more < step[key][0]):
                    step[key] = (cost + more, [*chosen, extra - 1])
        best = step
    return best[tau + 1]


def plan(distinct: DataFrame, tau: int) -> list[tuple[int, list[int], int]]:
    """``(mask, bits, threshold)`` of the parts that are probed."""
    both, n = _cooccurrence(distinct)
    if n < 2:
        return []
    p = np.clip(np.diag(both) / n, 0, 1)
    differ = np.clip(2 * p * (1 - p), 0, 0.9999)
    odds = differ / (1 - differ)
    layouts = [group_bits(both, n, parts) for parts in range(2, tau + 2)] or [[list(range(BITS))]]
    flat = [bits for layout in layouts for bits in layout]
    pairs = iter(_part_pairs(distinct, [_bits_mask(b) for b in flat]))
    best: tuple[float, list[tuple[int, list[int], int]]] | None = None
    for layout in layouts:
        costs = []
        for bits in layout:
            at_zero = next(pairs)
            near = np.array([1.0])  # elementary symmetric sums of the odds: pairs at 0, 1, .. bits
            for o in odds[bits]:
                near = np.append(near, 0.0) + o * np.append(0.0, near)
                near = near[: tau + 1]
            row = [0.0]
            for t in range(tau + 1):
                probes = n * sum(comb(len(bits), k) for k in range(t + 1))
                row.append(PROBE_COST * probes + at_zero * near[: t + 1].sum())
            costs.append(row)
        cost, thresholds = allocate(costs, tau)
        chosen = [
            (_bits_mask(b), b, t) for b, t in zip(layout, thresholds, strict=True) if t >= 0
        ]
        if best is None or cost < best[0]:
            best = (cost, chosen)
    return best[1]


# ---- probe and verify ---------------------------------------------------------------------


def _flips(bits: list[int], t: int) -> list[int]:
    """Bit masks of at most ``t`` of ``bits``; the empty one first."""
    out = [0]
    layer = [(0, -1)]
    for _ in range(t):
        layer = [(m | 1 << bits[j], j) for m, i in layer for j in range(i + 1, len(bits))]
        out += [m for m, _ in layer]
    return out


def _probes(distinct: DataFrame, parts: list[tuple[int, list[int], int]]) -> DataFrame:
    rows = []
    for i, (mask, bits, t) in enumerate(parts):
        for k, flip in enumerate(_flips(bits, t)):
            value = F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long"))
            rows.append(
                F.struct(
                    F.lit(i).alias("part"),
                    value.bitwiseXOR(F.lit(_signed(flip)).cast("long")).alias("value"),
                    F.lit(k > 0).alias("probe"),
                )
            )
    return distinct.select("fp", F.explode(F.array(*rows)).alias("s")).select("fp", "s.*")


def _blocked(probes: DataFrame, block_rows: int) -> DataFrame:
    """Buckets over ``block_rows`` rows as pairs of blocks (``lo``, ``hi``); others as (0, 0)."""
    big = (
        probes.groupBy("part", "value")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > block_rows)
        .select("part", "value", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    )
    rows = probes.join(big, ["part", "value"], "left").withColumn(
        "block", F.pmod(F.xxhash64("fp", "part"), F.coalesce("blocks", F.lit(1))).cast("int")
    )
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    return rows.withColumn("other", F.explode(others)).select(
        "part",
        "value",
        F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"),
        "probe",
        "fp",
    )


def link_groups(keys: np.ndarray, probe: np.ndarray, fps: np.ndarray, tau: int) -> list[tuple]:
    """A spanning forest of the links inside each run of equal ``keys`` rows.

    Rows of a run are compared at growing distance, all runs at once. Two probes are not
    compared: each is a neighbour of a value that stands in its own bucket.
    """
    n = len(fps)
    if n < 2:
        return []
    starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    ends = np.append(starts[1:], n)
    end = np.repeat(ends, ends - starts)
    parent = np.arange(n)
    found: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows = np.flatnonzero(~probe)  # sorted first in their run
    step = 1
    while True:
        rows = rows[rows + step < end[rows]]
        if not len(rows):
            return found
        other = rows + step
        near = np.bitwise_count(fps[rows] ^ fps[other]) <= tau
        a, b = rows[near], other[near]
        apart = parent[a] != parent[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            ri, rj = root(i), root(j)
            if ri != rj:
                parent[rj] = ri
                if fps[i] != fps[j]:
                    found.append((i, j))
        step += 1


def links(distinct: DataFrame, tau: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(u, v)``: links that connect every pair of fingerprints within ``tau`` bits."""
    parts = plan(distinct, tau)
    spark = distinct.sparkSession
    if not parts:
        return spark.createDataFrame([], "u long, v long")
    blocked = _blocked(_probes(distinct, parts), block_rows)
    key = ["part", "value", "lo", "hi"]
    dealt = blocked.repartition(*key).sortWithinPartitions(*key, "probe", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def answer(keys, probe, fps) -> pa.RecordBatch:
            found = np.array(link_groups(keys, probe, fps, tau), dtype=np.int64).reshape(-1, 2)
            signed = fps.view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(signed[found[:, 0]]), pa.array(signed[found[:, 1]])], names=["u", "v"]
            )

        for b in batches:
            keys = np.stack(
                [b[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in key], axis=1
            )
            probe = b["probe"].to_numpy(zero_copy_only=False).astype(bool)
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            if held is not None:
                keys = np.concatenate([held[0], keys])
                probe = np.concatenate([held[1], probe])
                fps = np.concatenate([held[2], fps])
            if not len(fps):
                continue
            # the last run may go on in the next batch; runs are bounded by two blocks
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield answer(keys[:cut], probe[:cut], fps[:cut])
            held = (keys[cut:], probe[cut:], fps[cut:])
        if held is not None and len(held[2]):
            yield answer(*held)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def _assigned(fps: DataFrame, tau: int, block_rows: int) -> DataFrame:
    """``(fp, root)`` of the distinct fingerprints that have a link."""
    distinct = materialise(fps.select("fp").distinct(), "simhash-distinct")
    return materialise(connected_components(links(distinct, tau, block_rows)), "simhash-roots")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, tau: int = MAX_BITS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest linked id)."""
    fps = materialise(fingerprints(docs, shingle), "simhash-fp")
    roots = _assigned(fps, tau, block_rows)
    own = fps.groupBy("fp").agg(F.min("doc_id").alias("own_id"))
    grouped = own.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "own_id", F.coalesce("root", "fp").alias("root")
    )
    grouped = materialise(grouped, "simhash-own")
    lowest = grouped.groupBy("root").agg(F.min("own_id").alias("component_id"))
    ids = grouped.join(lowest, "root").select("fp", "component_id")
    return fps.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, tau: int = MAX_BITS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per component: that of the smallest ``doc_id`` (nulls last), columns as given.

    Of several rows with that id the one with the smallest row hash stays, once.
    """
    row_hash = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    fps = materialise(fingerprints(docs, shingle, row_hash.alias("row_hash")), "simhash-fp")
    roots = _assigned(fps, tau, block_rows)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    best = fps.groupBy("fp").agg(F.min(order).alias("best"))
    best = best.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.coalesce("root", "fp").alias("root"), "best"
    )
    keepers = best.groupBy("root").agg(F.min("best").alias("k"))
    key = F.coalesce(F.col("k.doc_id"), F.lit(0))  # the hash tells a null from a 0
    keys = materialise(
        keepers.select(F.col("k.row_hash").alias("__hash"), key.alias("__id")).distinct(),
        "simhash-keepers",
    )
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        row_hash.alias("__hash"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"),
    )
    # the join leaves equal keys together and sorted, so the grouping moves nothing again
    one = held.join(keys, ["__hash", "__id"]).groupBy("__hash", "__id")
    return one.agg(F.first("__row").alias("__row")).select("__row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every document's fingerprint and component."""
    return near_duplicates(table(spark, sf_dir, "documents"))
