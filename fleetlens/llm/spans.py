"""Native helpers for spans in texts: regex matches with code-point positions.

Spark's regex functions return strings, not positions. Here every match is put between two
marks (U+0001, which no pattern used here can match; one in the text is first swapped for
U+0002, of the same length), the text is split at the marks, and running sums of the segment
lengths give the positions. Everything is an expression over one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.llm.common import let

MARK, SWAP = "\x01", "\x02"
BLOCK = 256  # array elements that are appended to one by one
CONTEXT = 24


def _running_small(xs: Column) -> Column:
    start = F.struct(
        F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("out")
    )
    return F.aggregate(
        xs,
        start,
        lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"),
            F.concat(acc["out"], F.array(acc["sum"] + x)).alias("out"),
        ),
        lambda acc: acc["out"],
    )


def running_sums(xs: Column) -> Column:
    """Running sums of an array of longs, in blocks: appending to one long array would take
    time with the square of its size."""

    def of(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(v) / BLOCK).cast("int") - 1),
            lambda b: _running_small(F.slice(v, b * BLOCK + 1, BLOCK)),
        )

        def shifted(bs: Column) -> Column:
            totals = _running_small(F.transform(bs, lambda b: F.element_at(b, -1)))
            return let(
                totals,
                lambda t: F.flatten(
                    F.transform(
                        bs,
                        lambda b, i: F.transform(
                            b, lambda x: x + F.coalesce(F.get(t, i - 1), F.lit(0).cast("long"))
                        ),
                    )
                ),
            )

        return let(blocks, shifted)

    return let(xs, of)


def swapped(text: Column) -> Column:
    """The text with U+0001 swapped for U+0002; empty for null."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.contains(MARK), F.translate(t, MARK, SWAP)).otherwise(t)


def matches(
    text: Column,
    pattern: str,
    keep: Callable[[Column], Column],
    only_if: Column | None = None,
    also: Callable[[Column], list[Column]] | None = None,
) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` in a ``swapped`` text for which ``keep``
    (a predicate over the match) holds: array of struct (start, end, value, before, after).

    ``before`` and ``after`` are up to ``CONTEXT`` characters beside the match, no further than
    the neighbouring matches; ``also`` adds named columns from the match. ``only_if`` may name a
    cheap condition without which there is no match.
    """
    marked = F.regexp_replace(text, pattern, f"{MARK}$0{MARK}")
    segments = F.split(marked, MARK)
    if only_if is not None:
        segments = F.when(only_if, segments).otherwise(F.array(F.lit("")))

    def spans(segs: Column) -> Column:
        ends = running_sums(F.transform(segs, lambda s: F.length(s).cast("long")))

        def one(end: Column) -> Column:
            return F.transform(
                F.filter(
                    F.sequence(F.lit(1), F.size(segs) - 2, F.lit(2)),
                    lambda i: keep(F.get(segs, i)),
                ),
                lambda i: F.struct(
                    F.get(end, i - 1).alias("start"),
                    F.get(end, i).alias("end"),
                    F.get(segs, i).alias("value"),
                    F.right(F.get(segs, i - 1), F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(segs, i + 1), F.lit(CONTEXT)).alias("after"),
                    *(also(F.get(segs, i)) if also else []),
                ),
            )

        return F.when(F.size(segs) > 2, let(ends, one))

    return let(segments, spans)


def or_empty(spans: Column, kind: str) -> Column:
    return F.coalesce(spans, F.array().cast(kind))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` have a valid check digit."""

    def total(d: Column) -> Column:
        def term(i: Column) -> Column:
            x = F.substr(d, F.length(d) - i, F.lit(1)).cast("int")
            doubled = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
            return F.when(i % 2 == 1, doubled).otherwise(x)

        return F.aggregate(
            F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda s, i: s + term(i)
        )

    return let(digits_of(value), lambda d: total(d) % 10 == 0)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans (start, rank, kind, end), by start and rank, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
