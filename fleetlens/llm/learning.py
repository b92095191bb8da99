"""What the operators that learn from ``labels`` share: the folds and the bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the fold that nothing is learnt from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``(doc_id, y)``: at most ``max_rows`` labelled ids outside the held-out fold.

    The ids with the smallest hashes are taken, so the sample is the same in every run; hashes
    are thinned to little more than is needed before they are sorted. Rows without an id or a
    label are left out; an id labelled more than once counts as 1 if any of its labels is.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("y").cast("int")).alias("y"))
        .withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    )
    n = rows.count()
    if n > 2 * max_rows:
        rows = rows.filter(F.col("h") < int((1 << 40) * 1.5 * max_rows / n))
    return rows.orderBy("h", "doc_id").limit(max_rows).select("doc_id", "y")
