"""Placement by chains of sampled seeds: a few k-mers of every window, joined up along both texts.

Where ``seeding`` counts every k-mer of the targets, this looks at about 2 / (w + 1) of them, and a gap in
a read costs a chain a little instead of splitting its votes. A definition of its own, after
published descriptions of window minima, adaptive seeds and collinear chaining.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.arrays import let
from readloom.operators import seeding
from readloom.operators.seeding import _SPANS, FILTER_SEEDS
from readloom.operators.staging import stage

K = 15
# K-mers in a window, of which the least is taken.
W = 8
# Places in the targets up to which ``anchors`` takes a read's seeds, from the rarest on; ``chain_reads`` takes all.
PLACES = 64
# Diagonals of a band; bands overlap by half.
BAND = 128
# Bases by which two steps may differ for a loss of one.
SLACK = 4
MIN_SCORE = 30


def minimisers(
    df: DataFrame, ids: Sequence[str], text: str, k: int = K, w: int = W, order: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """``ids, i, word``: the k-mers (starts ``i`` from 1) that are the least by ``order``, the first of equals, of some window of ``w``.

    Equal stretches of two texts of ``k + w - 1`` letters share one. Texts of fewer than ``w`` k-mers are one
    window; those shorter than ``k`` have none. Windows are cut out in rounds and every k-mer is ordered once per piece.
    """
    tail = k + w - 2
    windows = F.greatest(F.length(text) - tail, F.lit(1))
    parts = df.where(F.length(text) >= k).select(*ids, F.lit(0).alias("_base"), windows.alias("_own"), F.col(text).alias("_part"))
    for size in _SPANS:
        done = F.col("_w") * size
        # Beyond its own windows a piece reads on to the last one that shares a k-mer with them.
        parts = (
            parts.withColumn("_w", F.explode(F.sequence(F.lit(0), F.floor((F.col("_own") - 1) / size).cast("int"))))
            .withColumn("_part", F.substr("_part", done + 1, F.lit(size + tail + w - 1)))
            .withColumn("_own", F.least(F.lit(size), F.col("_own") - done))
            .withColumn("_base", F.col("_base") + done)
            .drop("_w")
        )
    part = F.col("_part")
    words = F.transform(
        F.sequence(F.lit(1), F.length(part) - (k - 1)),
        lambda j: F.struct(order(F.substr(part, j, F.lit(k))).alias("o"), j.alias("j")),
    )
    least = let(
        words,
        lambda xs: F.transform(
            F.sequence(F.lit(1), F.least(F.col("_own") + (w - 1), F.greatest(F.size(xs) - (w - 1), F.lit(1)))),
            lambda s: F.array_min(F.slice(xs, s, F.lit(w)))["j"],
        ),
    )
    # A k-mer may be the least of windows in two pieces: the later one gives it, so no shuffle has to find it twice.
    given = let(least, lambda js: F.array_except(F.slice(js, F.lit(1), F.col("_own")), F.slice(js, F.col("_own") + 1, F.lit(w))))
    return parts.withColumn("_j", F.explode(given)).select(
        *ids, (F.col("_base") + F.col("_j")).alias("i"), F.substr(part, F.col("_j"), F.lit(k)).alias("word")
    )


def anchors(reads: DataFrame, targets: DataFrame, read_id: str, target_id: str, places: int | None = PLACES) -> DataFrame:
    """``read_id, target_id, x, y``: where seeds of the reads (``i, word``) occur in the targets.

    Without ``places`` every seed meets all its places. With it a read takes its seeds from the rarest in the targets on, while
    the places of those taken are ``places`` or fewer in all; the rarest one it takes whatever it costs. So a seed that a third of the
    reads and of the targets share meets only the reads that have nothing rarer, and partners beyond those are not found.

    With ``places``, seeds of the targets that no read has are left where they are, by a bitmap of fixed size (see ``seeding``), and what
    is left is staged, as it is counted before it is joined. Without, ``minimisers_among`` gives the targets' seeds that matter.
    """
    if places is None:
        met = reads.select(read_id, "word", F.col("i").alias("x")).join(targets.select(target_id, "word", F.col("i").alias("y")), "word")
        return met.select(read_id, target_id, "x", "y")
    reads = stage(reads.select(read_id, "i", "word"), "read_seeds", "zstd")
    targets = targets.select(target_id, "i", F.col("word").alias("kmer"))
    if reads.count() <= FILTER_SEEDS:
        targets = seeding._may_match(targets, reads.select(F.col("word").alias("kmer")))
    targets = stage(targets.withColumnRenamed("kmer", "word"), "target_seeds", "zstd")
    often = targets.groupBy("word").agg(F.count("*").alias("_often"))
    met = reads.join(often, "word")
    by_rarity = Window.partitionBy(read_id).orderBy("_often", "i")
    so_far = F.sum("_often").over(by_rarity.rowsBetween(Window.unboundedPreceding, 0))
    ranked = met.withColumn("_sum", so_far).withColumn("_rank", F.row_number().over(by_rarity))
    kept = ranked.where((F.col("_sum") <= places) | (F.col("_rank") == 1)).select(read_id, "word", F.col("i").alias("x"))
    return kept.join(targets.select(target_id, "word", F.col("i").alias("y")), "word").select(read_id, target_id, "x", "y")


def best_end(ys: Sequence[int], xs: Sequence[int], k: int) -> tuple[int, int, int]:
    """``(score, y, x)`` at the end of the best chain of anchors of one band, in order of ``y, x``; of equal scores the first end.

    Scores rise along a diagonal by as much as a step counts, so of the anchors of a diagonal only the last one
    before an anchor can lead to it best: an anchor costs a search per diagonal of the band, however many there are.
    """
    found: dict[int, tuple[list[int], list[int]]] = {}
    top = (0, 0, 0)
    for y, x in zip(ys, xs, strict=True):
        own, best = y - x, k
        for diagonal, (starts, scores) in found.items():
            # Before it in both texts.
            n = bisect_left(starts, y if diagonal >= own else y - own + diagonal)
            if n:
                dy = y - starts[n - 1]
                off = diagonal - own
                best = max(best, scores[n - 1] + min(dy, dy + off, k) - (abs(off) + SLACK - 1) // SLACK)
        starts, scores = found.setdefault(own, ([], []))
        starts.append(y)
        scores.append(best)
        if best > top[0]:
            top = (best, y, x)
    return top


def chains(
    found: DataFrame, read_id: str, target_id: str, k: int = K, band: int = BAND, min_score: int = MIN_SCORE
) -> DataFrame:
    """``read_id, target_id, score, diag``: the best chain of each read and target that scores ``min_score`` or more.

    A chain runs up both texts inside a band of ``band`` diagonals; bands overlap by half. Its first seed counts
    ``k``, each further one the bases it adds, ``k`` at most, less one for every ``SLACK`` bases by which the two steps
    differ. ``diag`` is target less read position at the end of the chain; of equal scores the first end. A read meets a
    band of a target in one row, which holds at most as many seeds as the read has, times ``band``.
    """
    diag = F.col("y") - F.col("x")
    bands = F.array(
        F.struct(F.lit(0).alias("half"), F.floor(diag / band).cast("int").alias("band")),
        F.struct(F.lit(1).alias("half"), F.floor((diag + band // 2) / band).cast("int").alias("band")),
    )
    place = F.shiftleft(F.col("y").cast("bigint"), 32) + F.col("x")
    grouped = found.withColumn("_b", F.explode(bands)).groupBy(read_id, target_id, "_b.half", "_b.band").agg(
        F.array_sort(F.collect_list(place)).alias("_a")
    )
    ids = grouped.select(F.col(read_id).alias("_read"), F.col(target_id).alias("_target"), "_a")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_a")
            found = []
            for i in range(len(lists)):
                at = lists[i].values.to_numpy()
                found.append(best_end((at >> 32).tolist(), (at & 0xFFFFFFFF).tolist(), k))
            scores = [pa.array(c, pa.int32()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int32())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("_read"), batch.column("_target"), *scores], names=["_read", "_target", "f", "y", "x"])

    # Executors need not have this package: what the tasks run travels with the query.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = ", ".join(f"{c} {ids.schema[c].dataType.simpleString()}" for c in ("_read", "_target"))
    scored = ids.mapInArrow(ends, schema + ", f int, y int, x int").withColumnsRenamed({"_read": read_id, "_target": target_id})
    end = F.struct((-F.col("f")).alias("f"), "y", "x")
    best = scored.groupBy(read_id, target_id).agg(F.min(end).alias("_e"))
    return best.where(-F.col("_e.f") >= min_score).select(
        read_id, target_id, (-F.col("_e.f")).alias("score"), (F.col("_e.y") - F.col("_e.x")).alias("diag")
    )


# Bits that the words sought have in a bitmap, for each of them and at most, and places of a piece of text that are looked at at once.
WORD_BITS, MOST_BITS, PIECE = 64, 1 << 30, 1 << 16
_FACTOR, _MIX, _OTHER_MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def word_codes(text: str, k: int) -> np.ndarray:
    """A 64-bit code of each k-mer of a text, equal for equal k-mers."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(letters) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Codes of 1, 2, 4, ... letters, put together to k by its bits.
    whole, done, part, size = np.zeros(n, np.uint64), 0, letters, 1
    while True:
        if k & size:
            whole += part[done : done + n] * np.uint64(pow(_FACTOR, done, 1 << 64))
            done += size
        if done == k:
            break
        part = part[:-size] + part[size:] * np.uint64(pow(_FACTOR, size, 1 << 64))
        size *= 2
    whole ^= whole >> np.uint64(32)
    whole *= np.uint64(_MIX)
    whole ^= whole >> np.uint64(29)
    return whole


def _bits_of(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - bits)
    return codes >> shift, codes * np.uint64(_OTHER_MIX) >> shift


def _bitmap(words: DataFrame, k: int) -> tuple[np.ndarray, int]:
    """Two bits for each of the ``word``s in a bitmap of at most ``MOST_BITS``, and the power of two of its size."""
    bits = max(min(WORD_BITS * words.count(), MOST_BITS) - 1, 1 << 9).bit_length()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.concatenate([np.empty(0, np.uint64), *(word_codes(w, k) for w in batch.column("word").to_pylist())])
            at = np.unique(np.concatenate(_bits_of(codes, bits))).astype(np.int64)
            yield pa.record_batch([pa.array(at >> 6), pa.array(at & 63)], names=["slot", "bit"])

    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").cast("int"))
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    masks = words.select("word").mapInArrow(rows, "slot long, bit long").groupBy("slot").agg(F.bit_or(one).alias("mask")).toArrow()
    bitmap = np.zeros(1 << bits - 6, np.int64)
    bitmap[masks.column("slot").to_numpy()] = masks.column("mask").to_numpy()
    return bitmap.view(np.uint64), bits


def minimisers_among(
    df: DataFrame, ids: Sequence[str], text: str, words: DataFrame, k: int = K, w: int = W, order: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """Those of the ``minimisers`` whose ``word`` is one of the ``words`` (each of ``k`` letters), and few others; ``words`` is read twice.

    Places whose k-mer may be sought are found first, by codes of all k-mers of a text and a bitmap that tasks hold; only there the
    k-mers of the windows around are put in order. A k-mer is the least of some window where those next to it that are not less
    (on the left: greater), ``w - 1`` at most on a side, fill one together with it.
    """
    bitmap, bits = _bitmap(words, k)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    kept = [f"_id{i}" for i in range(len(ids))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(ids, kept, strict=True)], F.col(text).cast("string").alias("_text"))

    def places(text: str) -> np.ndarray:
        found = []
        for at in range(0, len(text) - k + 1, PIECE):
            codes = word_codes(text[at : at + PIECE + k - 1], k)
            one, two = _bits_of(codes, bits)
            near = np.flatnonzero(shared.value[(one >> np.uint64(6)).astype(np.int64)] >> (one & np.uint64(63)) & np.uint64(1))
            two = two[near]
            there = shared.value[(two >> np.uint64(6)).astype(np.int64)] >> (two & np.uint64(63)) & np.uint64(1)
            found.append(near[there == 1] + at)
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column("_text")):
                text = text.as_py()
                if text is None or len(text) < k:
                    continue
                found = places(text)
                size = min(len(text) - k + 1, w)
                for at in range(0, len(found), PIECE):
                    js = found[at : at + PIECE].tolist()
                    around = [text[max(j - w + 1, 0) : j + w - 1 + k] for j in js]
                    own = [batch.column(n).take(pa.array([row] * len(js))) for n in kept]
                    new = [pa.array([j + 1 for j in js], pa.int32()), pa.array([min(j, w - 1) for j in js], pa.int32()),
                           pa.array([size] * len(js), pa.int32()), pa.array(around, pa.string())]
                    yield pa.RecordBatch.from_arrays([*own, *new], names=[*kept, "i", "_before", "_window", "_around"])

    schema = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in kept]
    near = rows.mapInArrow(run, ", ".join([*schema, "i int", "_before int", "_window int", "_around string"]))
    before, around = F.col("_before"), F.col("_around")
    cut = lambda j: F.substr(around, j + 1, F.lit(k))
    first = lambda lost, n: F.coalesce(F.nullif(F.array_position(lost, F.lit(True)), F.lit(0)) - 1, n)

    def fills(orders: Column) -> Column:
        own = orders[before]
        after = F.size(orders) - before - 1
        left = F.transform(F.reverse(F.slice(orders, F.lit(1), before)), lambda o: o <= own)
        right = F.transform(F.slice(orders, before + 2, after), lambda o: o < own)
        return first(left, before) + first(right, after) + 1 >= F.col("_window")

    orders = F.transform(F.sequence(F.lit(0), F.length(around) - k), lambda j: order(cut(j)))
    least = near.where(let(orders, fills)).select(*kept, "i", cut(before).alias("word"))
    return least.toDF(*ids, "i", "word")


def chain_reads(
    reads: DataFrame, targets: DataFrame, read_id: str, target_id: str, text: str = "text",
    k: int = K, w: int = W, order: Callable[[Column], Column] = F.xxhash64, places: int | None = None, min_score: int = MIN_SCORE,
) -> DataFrame:
    """The best chain of every read and target, from their texts; all seeds of a read count unless ``places`` says otherwise."""
    seeds = stage(minimisers(reads, [read_id], text, k, w, order), "seeds", "zstd")
    theirs = minimisers_among(targets, [target_id], text, seeds, k, w, order)
    return chains(anchors(seeds, theirs, read_id, target_id, places), read_id, target_id, k, min_score=min_score)
