"""Ranked lexical search on K2-treaps: quadtrees over a grid of terms and documents whose cells hold impact maxima."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.staging import stage

#: Bytes of text behind one grid.
SHARD_BYTES = 4 << 20
#: Terms of all items that are looked up in one pass over the index.
BLOCK_TERMS = 200_000
#: Document ranges of an item that descend at once.
BEAM = 64
#: Tasks whose best documents meet in one task.
MERGED = 512
#: Best documents of an item.
TOP = 10
#: Bytes of a term: ASCII letters (A-Z lowered) and digits and all of UTF-8 beyond ASCII; the rest separates terms.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a whole text, in order and with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(TERMS).split() if text else []


def spaced(values: np.ndarray) -> np.ndarray:
    """Bits moved to the even places of a 64-bit word."""
    x = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


POPCOUNT = np.array([b.bit_count() for b in range(16)], np.int64)


@dataclass
class Treap:
    """Occupied cells of a square grid, level by level from the whole grid to single cells.

    ``masks`` has a bit per occupied quadrant (term half twice plus document half) and
    ``peaks`` the largest value inside, both in the order of a walk by levels. So
    the children of a cell are next to each other, from ``first`` on, which is a running count of bits.
    """

    height: int
    masks: np.ndarray
    peaks: np.ndarray

    def __post_init__(self) -> None:
        counts = POPCOUNT[self.masks]
        self.first = 1 + np.cumsum(counts) - counts

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        """The treap of at least one cell; no two at the same row and column."""
        height = int(max(rows.max(), columns.max())).bit_length()
        code = spaced(rows) << np.uint64(1) | spaced(columns)
        order = np.argsort(code)
        code, peak = code[order], values[order].astype(np.int32)
        masks, peaks = [np.zeros(len(code), np.uint8)], [peak]
        for _ in range(height):
            parent = code >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            bits = np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)
            masks.append(np.bitwise_or.reduceat(bits, starts))
            peak = np.maximum.reduceat(peak, starts)
            peaks.append(peak)
            code = parent[starts]
        return cls(height, np.concatenate(masks[::-1]), np.concatenate(peaks[::-1]))

    def best(self, rows: np.ndarray, weights: np.ndarray, top: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The columns with the largest weighted sums over ``rows``, and the sums: all that could be among the ``top``.

        All rows descend together over halves of the columns. A range of columns is bounded
        by the sum of its cells' peaks, ranges with the largest bounds go first, and a range ends
        where its bound is below the ``top``-th sum found so far (or ``floor``). Ties stay.
        """
        nodes = np.zeros((1, len(rows)), np.int64)
        bounds, levels, at = np.array([int(self.peaks[0]) * int(weights.sum())]), np.zeros(1, np.int64), np.zeros(1, np.int64)
        found, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        weights = weights.astype(np.int64)
        while len(bounds):
            if len(bounds) > BEAM:
                go = np.zeros(len(bounds), bool)
                go[np.argpartition(bounds, len(bounds) - BEAM)[-BEAM:]] = True
            else:
                go = np.ones(len(bounds), bool)
            single = go & (levels == self.height)
            if single.any():
                found, sums = np.concatenate([found, at[single]]), np.concatenate([sums, bounds[single]])
                if len(sums) >= top:
                    floor = max(floor, int(np.partition(sums, len(sums) - top)[len(sums) - top]))
                    found, sums = found[sums >= floor], sums[sums >= floor]
            inner = go & ~single
            if inner.any():
                own, level, column = nodes[inner], levels[inner], at[inner]
                half = rows[None, :] >> (self.height - 1 - level)[:, None] & 1
                there = np.maximum(own, 0)
                mask, first = self.masks[there], self.first[there]
                children = []
                for side in (0, 1):
                    bit = half * 2 + side
                    has = (own >= 0) & (mask >> bit & 1 == 1)
                    children.append(np.where(has, first + POPCOUNT[mask & ((1 << bit) - 1)], -1))
                below = np.concatenate(children)
                bound = np.where(below >= 0, self.peaks[np.maximum(below, 0)], 0).astype(np.int64) @ weights
                new = (below, bound, np.concatenate([level + 1] * 2), np.concatenate([column * 2, column * 2 + 1]))
            else:
                new = (nodes[:0], bounds[:0], levels[:0], at[:0])
            nodes, bounds, levels, at = (
                np.concatenate([old[~go], fresh]) for old, fresh in zip((nodes, bounds, levels, at), new, strict=True)
            )
            stays = (bounds >= max(floor, 1))
            nodes, bounds, levels, at = nodes[stays], bounds[stays], levels[stays], at[stays]
        return found, sums


def impact(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Value of a term in a document of ``n`` terms, out of ``docs`` documents with ``length`` terms; whole numbers."""
    m = 10 + 90 * n * docs // length
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of a task in runs of about ``size`` bytes of text, at least one row each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if j > i:
                yield batch.slice(i, j - i)


INDEX = {
    "ids": pa.list_(pa.int64()),
    "terms": pa.list_(pa.string()),
    "dfs": pa.list_(pa.int64()),
    "height": pa.int32(),
    "cells": pa.int64(),
    "masks": pa.binary(),
    "peaks": pa.binary(),
}
INDEX_SCHEMA = "ids array<long>, terms array<string>, dfs array<long>, height int, cells long, masks binary, peaks binary"


@dataclass
class Index:
    """``shards``: a row per grid, its ``masks`` and ``peaks`` packed; ``docs`` and ``length``: documents with a term, and all terms with repeats."""

    shards: DataFrame
    docs: int
    length: int


def build(documents: DataFrame, size: int = SHARD_BYTES) -> Index:
    """The index of all rows of ``(doc_id, text)``: a K2-treap over the terms and documents of every ``size`` bytes of text."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(terms_of(t.as_py())) for t in batch.column("text")]
            yield pa.record_batch({"docs": [sum(n > 0 for n in sizes)], "length": [sum(sizes)]})

    totals = rows.select("text").mapInArrow(count, "docs long, length long")
    docs, length = totals.agg(F.sum("docs"), F.sum("length")).first()
    docs, length = docs or 0, length or 0

    def grids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, size):
            if (grid := _grid(piece, docs, length)) is not None:
                yield pa.record_batch([pa.array([v], t) for v, t in zip(grid, INDEX.values(), strict=True)], list(INDEX))

    # A row group each: a grid has some MB, and the JVM reads and writes row groups whole, however many grids a split of the texts gives.
    return Index(stage(rows.mapInArrow(grids, INDEX_SCHEMA), "k2_treaps", group_rows=1), docs, length)


def _grid(piece: pa.RecordBatch, docs: int, length: int) -> tuple | None:
    known: dict[bytes, int] = {}
    terms, tfs, columns, ids, sizes = [], [], [], [], []
    for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text"), strict=True):
        counts = Counter(terms_of(text.as_py()))
        if counts:
            terms.append(np.array([known.setdefault(t, len(known)) for t in counts], np.int32))
            tfs.append(np.fromiter(counts.values(), np.int64, len(counts)))
            columns.append(np.full(len(counts), len(ids), np.int32))
            ids.append(doc_id)
            sizes.append(int(tfs[-1].sum()))
    if not ids:
        return None
    term, tf, column = np.concatenate(terms), np.concatenate(tfs), np.concatenate(columns)
    df = np.bincount(term, minlength=len(known))
    # Frequent terms next to each other: the peaks of the cells over rare ones stay apart from theirs.
    order = np.argsort(-df, kind="stable")
    row = np.empty(len(known), np.int64)
    row[order] = np.arange(len(known))
    treap = Treap.of(row[term], column, impact(tf, np.array(sizes, np.int64)[column], docs, length))
    words = list(known)
    names = [words[i].decode("utf-8", "surrogatepass") for i in order.tolist()]
    return ids, names, df[order], treap.height, len(treap.masks), _packed(treap.masks), _packed(treap.peaks)


def _packed(values: np.ndarray) -> bytes:
    """Bytes of an array, which the JVM holds several grids of at once, at less than half their size."""
    return pa.Codec("zstd", compression_level=1).compress(values.tobytes(), asbytes=True)


def _unpacked(data: pa.BinaryScalar, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data.as_buffer(), n * np.dtype(kind).itemsize, "zstd"), kind)


def queries_of(items: DataFrame) -> DataFrame:
    """Distinct ``(item_id, term)`` of ``(item_id, text)``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms = sorted({t.decode("utf-8", "surrogatepass") for t in terms_of(batch.column("text")[i].as_py())})
                one = pa.array([batch.column("item_id")[i].as_py()] * len(terms), pa.int64())
                yield pa.record_batch([one, pa.array(terms, pa.string())], names=["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(split, "item_id long, term string").distinct()


def search(documents: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item with the highest scores above 0.

    ``documents`` is ``(doc_id, text)``, ``items`` ``(item_id, text)``. A score sums weight times
    ``impact`` over the item's terms, once each; equal scores rank by doc_id, null last.

    Rows of an item_id (null is one) make one item together; rows of documents that repeat are
    documents of their own and rank side by side. Null, empty and termless texts hold no term, find
    nothing and count as no document. Texts of any length are indexed whole. Empty tables give no row. Other columns
    are not looked at.

    The index is written once; the items, dealt to blocks by a hash of their id so that a block has about
    ``block_terms`` terms, are searched a block after another in all grids. A grid hands on what can
    still be among the best of its task, and tasks are merged in two steps.
    """
    index = build(documents)
    if not index.docs:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    asked = stage(queries_of(items), "item_terms")
    dfs = index.shards.select(F.inline(F.arrays_zip("terms", "dfs"))).toDF("term", "df")
    dfs = dfs.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * index.docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = stage(asked.join(dfs, "term").select("item_id", "term", weight.alias("weight")), "weights")
    blocks = -(-weighted.count() // block_terms)
    best = None
    for k in range(blocks):
        some = weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else weighted
        found = _found(index, some.collect(), top)
        best = found if best is None else best.unionAll(found)
    if best is None:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = best.withColumn("part", F.floor(F.col("task") / MERGED))
    for keys in (["item_id", "part"], ["item_id"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return best.select("item_id", "rank", "doc_id", "score")


def _found(index: Index, terms: list, top: int) -> DataFrame:
    """``(task, item_id, doc_id, score)``: a task's best documents for a block of items."""
    queries: dict[int | None, list[tuple[str, int]]] = {}
    for r in terms:
        queries.setdefault(r["item_id"], []).append((r["term"], r["weight"]))
    shared = index.shards.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, list[tuple]] = {}
        wanted = {t for q in shared.value.values() for t, _ in q}
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {name: batch.column(name)[i] for name in INDEX if name not in ("dfs",)}
                _search_shard(shard, shared.value, wanted, best, top)
        rows = [(item, d, s) for item, found in best.items() for _, _, d, s in found]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    found = index.shards.select([c for c in INDEX if c != "dfs"]).mapInArrow(run, "item_id long, doc_id long, score long")
    return found.select(F.spark_partition_id().alias("task"), "item_id", "doc_id", "score")


def _search_shard(shard: dict, queries: dict, wanted: set[str], best: dict, top: int) -> None:
    """Merge the best documents of a grid into ``best``: per item, up to ``top`` of (-score, id is null, id, score) in order."""
    cells = shard["cells"].as_py()
    treap = Treap(shard["height"].as_py(), _unpacked(shard["masks"], cells, np.uint8), _unpacked(shard["peaks"], cells, np.int32))
    names = shard["terms"].values
    at = pc.indices_nonzero(pc.is_in(names, pa.array(sorted(wanted), pa.string())))
    rows = dict(zip(names.take(at).to_pylist(), at.to_pylist(), strict=True))
    ids = shard["ids"].values.to_pylist()
    for item, terms in queries.items():
        here = [(rows[t], w) for t, w in terms if t in rows and w > 0]
        if here:
            mine = best.setdefault(item, [])
            floor = -mine[-1][0] if len(mine) >= top else 0
            columns, sums = treap.best(*(np.array(x, np.int64) for x in zip(*here, strict=True)), top, floor)
            for c, s in zip(columns.tolist(), sums.tolist(), strict=True):
                mine.append((-s, ids[c] is None, ids[c], s))
            mine.sort(key=lambda r: (r[0], r[1], r[2] or 0))
            del mine[top:]
