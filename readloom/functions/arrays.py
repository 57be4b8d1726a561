"""Column helpers on arrays, for use inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def indices(n: Column) -> Column:
    """``[0 .. n-1]``; empty for 0, where ``sequence`` would count down."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running_starts(lengths: Column) -> Column:
    """Sum of the entries before each entry of an ``array<int>``.

    Chunks of about sqrt(n) entries are summed first, so an entry costs about
    sqrt(n) additions and no array grows step by step.
    """
    add = lambda total, x: total + x
    zero = F.lit(0)

    def from_chunks(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, zero, add))
        return let(
            sums,
            lambda s: F.flatten(
                F.transform(
                    chunks,
                    lambda c, k: let(
                        F.aggregate(F.slice(s, F.lit(1), k), zero, add),
                        lambda base: F.transform(c, lambda _, i: base + F.aggregate(F.slice(c, F.lit(1), i), zero, add)),
                    ),
                )
            ),
        )

    def split_up(xs: Column) -> Column:
        return let(
            F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs))).cast("int")),
            lambda width: let(
                F.transform(
                    indices(F.ceil(F.size(xs) / width).cast("int")), lambda k: F.slice(xs, k * width + 1, width)
                ),
                from_chunks,
            ),
        )

    return let(lengths, split_up)
