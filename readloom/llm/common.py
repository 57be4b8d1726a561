"""What several operators share: words, native text matches, local and distributed components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.arrays import let, running_starts
from readloom.operators.staging import stage

#: ASCII white space, as ``bytes.split`` takes it: x20 and x09 to x0D.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lowered; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


ARROW = {"string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "long": pa.int64(), "boolean": pa.bool_()}


def map_texts(
    docs: DataFrame,
    keep: Sequence[str],
    start: Callable[[], Callable[[list[str | None]], list[Iterable]]],
    columns: dict[str, str],
    size: int = 4 << 20,
) -> DataFrame:
    """The ``keep`` columns as they are and new ``columns`` (name to type) made from whole texts in tasks.

    A task calls ``start`` once, and what that returns with the texts of one slice
    after another; a slice holds about ``size`` bytes of text, and one row at least.
    Kept columns never leave Arrow, so nulls and long ids survive; they have other
    names meanwhile, so none can clash.
    """
    kept = [f"kept_{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(c).alias(n) for c, n in zip(keep, kept, strict=True)], F.col("text").cast("string").alias("text")
    )
    added = [f"new_{i}" for i in range(len(columns))]
    types = [ARROW[t] for t in columns.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(lengths, dtype=np.int64) // size
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if j > i:
                    piece = batch.slice(i, j - i)
                    made = make(piece.column("text").to_pylist())
                    new = [pa.array(x, t) for x, t in zip(made, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in kept), *new], names=[*kept, *added])

    schema = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in kept]
    schema += [f"{n} {t}" for n, t in zip(added, columns.values(), strict=True)]
    return rows.mapInArrow(run, ", ".join(schema)).toDF(*keep, *columns)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a Java pattern as ``array<struct<start, stop, value, before, after>>``.

    Offsets count code points, ``stop`` is exclusive; ``before`` and ``after`` are
    up to 48 characters on either side, as far as the neighbouring matches. The
    pattern must not match the empty string. The text between the matches gives the
    offsets, so a row costs two passes of the pattern.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def spans(found: Column, between: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(m) + F.length(between[i]))
        return let(
            running_starts(steps),
            lambda starts: F.transform(
                found,
                lambda m, i: let(
                    starts[i] + F.length(between[i]),
                    lambda start: F.struct(
                        start.alias("start"),
                        (start + F.length(m)).alias("stop"),
                        m.alias("value"),
                        F.right(between[i], F.lit(48)).alias("before"),
                        F.left(between[i + 1], F.lit(48)).alias("after"),
                    ),
                ),
            ),
        )

    return let(found, lambda m: let(between, lambda b: spans(m, b)))


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(node, smallest node of its component)`` that hold the same components as the links ``(u, v)``."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (root[a], root[b], a, b):
            np.minimum.at(new, end, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every end of a link; ``component_id`` is the smallest id reachable.

    ``links`` has two long columns ``a`` and ``b``. Each round every node points to
    its smallest neighbour, pointers are shortened, and the links between what is
    left are drawn anew, so the graph shrinks fast. Rounds are written to the shared
    folder: none repeats an earlier one, and the driver sees only whether links are left.
    """

    def tidy(df: DataFrame) -> DataFrame:
        a, b = F.col("a"), F.col("b")
        return stage(df.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")

    def shorten(pointers: DataFrame) -> DataFrame:
        target = pointers.select(F.col("id").alias("up"), F.col("parent").alias("top"))
        return pointers.join(target, pointers["parent"] == target["up"]).select("id", F.col("top").alias("parent"))

    left = tidy(links)
    roots = None
    while not left.isEmpty():
        ends = left.select(F.col("b").alias("id"), F.col("a").alias("other")).unionAll(
            left.select(F.col("a").alias("id"), F.col("a").alias("other"))
        )
        pointers = stage(ends.groupBy("id").agg(F.min("other").alias("parent")), "pointers")
        pointers = stage(shorten(shorten(pointers)), "pointers")
        up = pointers.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        down = pointers.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        left = tidy(left.join(up, "a").join(down, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")))
        if roots is None:
            roots = pointers
        else:
            roots = (
                roots.join(up, roots["parent"] == up["a"], "left")
                .select("id", F.coalesce("pa", "parent").alias("parent"))
            )
    if roots is None:
        roots = left.select(F.col("a").alias("id"), F.col("b").alias("parent"))
    return roots.select("id", F.col("parent").alias("component_id"))
