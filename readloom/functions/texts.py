"""Pieces of long texts. A substring walks from the start of its text, so long ones are cut in rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from readloom.functions.arrays import indices, let

# Characters of a piece, round by round: a character is walked over about 16 times in each.
ROUNDS = (1 << 23, 1 << 18, 1 << 13)


def _cut(text: Column, size: int) -> Column:
    return F.transform(
        indices(F.ceil(F.length(text) / size).cast("int")), lambda k: F.substr(text, k * size + 1, F.lit(size))
    )


def blocks_of(text: Column, rounds: tuple[int, ...] = ROUNDS) -> Column:
    """The text as an array of blocks of ``rounds[-1]`` characters, the last one shorter; empty for an empty text."""

    def finer(blocks: Column, size: int) -> Column:
        return F.flatten(F.transform(blocks, lambda part: _cut(part, size)))

    blocks = F.array(text)
    for size in rounds:
        blocks = finer(blocks, size)
    short = F.length(text) <= rounds[-1]
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(short, F.array(text)).otherwise(blocks)


def piece(blocks: Column, start: Column, n: Column, size: int = ROUNDS[-1]) -> Column:
    """``n`` characters from ``start`` (from 0) of a text given as ``blocks`` of ``size``: only blocks that it touches are read."""
    first = F.floor(start / size).cast("int")
    last = F.floor((start + n - 1) / size).cast("int")
    joined = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.when(n > 0, F.substr(joined, start - first * size + 1, n)).otherwise(F.lit(""))


def running_max(values: Column, least: Column) -> Column:
    """The largest entry before each entry of an array, ``least`` before the first; in chunks of about sqrt(n)."""
    top: Callable[[Column, Column], Column] = lambda best, x: F.greatest(best, x)

    def from_chunks(chunks: Column) -> Column:
        tops = F.transform(chunks, lambda c: F.array_max(c))
        return let(
            tops,
            lambda t: F.flatten(
                F.transform(
                    chunks,
                    lambda c, k: let(
                        F.aggregate(F.slice(t, F.lit(1), k), least, top),
                        lambda base: F.transform(c, lambda _, i: F.aggregate(F.slice(c, F.lit(1), i), base, top)),
                    ),
                )
            ),
        )

    def split_up(xs: Column) -> Column:
        return let(
            F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs))).cast("int")),
            lambda width: let(
                F.transform(indices(F.ceil(F.size(xs) / width).cast("int")), lambda k: F.slice(xs, k * width + 1, width)),
                from_chunks,
            ),
        )

    return let(values, split_up)
