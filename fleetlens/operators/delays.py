"""Q5: average delay per bus line over at-stop reports, ordered by the average.

The reference folds ``(delay, 1)`` pairs per line with ``(|a| + |b|, n_a + n_b)``. The fold
is never applied to a line with a single report, so that line's average is its *signed*
delay; with two or more reports every term ends up absolute, whatever the partitioning.
``line_delay_average`` reproduces that; ``line_abs_delay_average`` is the plain mean of
absolute delays. Both are one hash aggregate with a partial stage: lines are few, so at most
one row per line per map task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import flag_set
from fleetlens.operators._checks import require_columns


def _at_stop(m: DataFrame) -> DataFrame:
    require_columns(m, "atStop", "busLineID", "delay")
    return m.filter(flag_set(F.col("atStop")))


def _abs_delay():
    # widen first: abs(INT_MIN) overflows an int
    return F.abs(F.col("delay").cast("long"))


def line_delay_average(m: DataFrame) -> DataFrame:
    """``(lineID, average)``; a one-report line keeps its signed delay."""
    agg = _at_stop(m).groupBy("busLineID").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("delay").cast("long")).alias("_s"),
        F.sum(_abs_delay()).alias("_a"),
    )
    total = F.when(F.col("_n") == 1, F.col("_s")).otherwise(F.col("_a"))
    return agg.select(
        F.col("busLineID").alias("lineID"),
        (total.cast("double") / F.col("_n")).alias("average"),
    ).orderBy("average", "lineID")


def line_abs_delay_average(m: DataFrame) -> DataFrame:
    """``(lineID, average)`` = mean of ``|delay|`` per line."""
    return (
        _at_stop(m)
        .groupBy(F.col("busLineID").alias("lineID"))
        .agg(F.avg(_abs_delay()).alias("average"))
        .orderBy("average", "lineID")
    )


def line_delay_sum_count(m: DataFrame) -> DataFrame:
    """``(busLineID, sum_delay, n)``: the sum of ``|delay|`` and the count, in one pass."""
    return _at_stop(m).groupBy("busLineID").agg(
        F.sum(_abs_delay()).alias("sum_delay"),
        F.count(F.lit(1)).alias("n"),
    )
