"""Connected components of an edge list, as DataFrame rounds.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every step replaces a node's edges by edges to the smallest node
it knows, so the list shrinks to one star per component in a logarithmic number of rounds. The
minimum per node is a plain aggregate with partial results; the edges meet it in a join, which
adaptive execution can split when one node has very many edges. Each round is written to the
shared folder, so a lost executor costs one round at most and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    to_low = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select("u", F.col("m").alias("v"))
    return to_low.union(own).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return int(row["n"]), int(row["h"] or 0)


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; the root is the smallest node.

    Null ends and loops are ignored; edges may be repeated and given either way.
    """
    now = materialise(
        edges.select("u", "v").filter("u <> v"),
        "cc-edges",
    )
    before = _state(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        now = materialise(_small_star(_large_star(now)), "cc-round")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    return (
        now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("root")))
        .distinct()
    )
