"""Approximate nearest neighbours by multi-index hashing of learned, rotated binary codes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.llm.vectors import matrix, unit, usable
from readloom.operators.staging import stage

#: Bits of a code, in substrings of 16.
BITS = 128
PIECE = 16
#: Bound of the sample from which rotation and radius are learned.
SAMPLE = 4096
#: Share of true neighbours in the sample that the radius must reach.
TARGET = 0.98
#: Vectors of a block of the index, and queries that meet a block at once.
BLOCK = 8192


@dataclass
class Coder:
    """A code's bits are the signs after ``rotation``; ``radius`` is the Hamming distance to search."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """``(n, BITS / 16)`` substrings."""
        bits = (unit(x) - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)

    @classmethod
    def all_of(cls, group: pa.Table) -> Coder:
        """A coder for vectors that are few enough to be compared one and all: its radius is the whole code."""
        dim = len(group.column("embedding")[0])
        return cls(np.zeros(dim), np.random.default_rng(dim).normal(size=(dim, BITS)), BITS)


def learn(x: np.ndarray, k: int, seed: int = 0) -> Coder:
    """Iterative quantisation: rotations that bring the sample near to the corners of a cube; then the radius for ``k``."""
    rng, x = np.random.default_rng(seed), unit(x)
    mean = x.mean(axis=0)
    centred, dim = x - mean, x.shape[1]
    parts = []
    for _ in range(-(-BITS // dim)):
        turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(20):
            left, _, right = np.linalg.svd(centred.T @ np.sign(centred @ turn), full_matrices=False)
            turn = left @ right
        parts.append(turn)
    coder = Coder(mean, np.concatenate(parts, axis=1)[:, :BITS], BITS)
    asked = np.arange(0, len(x), max(1, len(x) // 256))
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -2
    best = np.argsort(-near, axis=1)[:, : min(k, len(x) - 1)]
    codes = coder.codes(x)
    far = np.bitwise_count(codes[asked][:, None, :] ^ codes[best]).sum(axis=2, dtype=np.int64)
    if far.size:
        coder.radius = int(np.quantile(far, TARGET, method="higher"))
    return coder


class Block:
    """The distinct vectors of a block, their codes, a directory of occupied values for each substring, and who has each vector.

    ``members`` holds the ids of every distinct vector in order, no more than could be among the
    best ``k`` of a query that is one of them itself.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, coder: Coder, k: int) -> None:
        order = np.lexsort((ids, *x.T[::-1]))
        ids, x = ids[order], x[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])
        self.members = [np.unique(m)[: k + 1] for m in np.split(ids, np.flatnonzero(new)[1:])]
        self.sizes = np.array([len(m) for m in self.members])
        self.x = unit(x[new])
        self.codes = coder.codes(x[new])
        self.pieces = [np.unique(self.codes[:, j], return_inverse=True) for j in range(self.codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Vectors whose code lies within the radius: such a code has a substring within radius / pieces.

        Of each substring's ball only occupied values are probed; the directory of
        a block is smaller than a ball of 16-bit values is at the radii used.
        """
        found = np.zeros(len(self.codes), bool)
        for j, (values, at) in enumerate(self.pieces):
            found |= (np.bitwise_count(values ^ code[j]) <= radius // len(self.pieces))[at]
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64) <= radius]

    def best(self, rows: np.ndarray, query: int, q: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` nearest others among ``rows``, as ``(-score, id)`` in order.

        A matrix product, whose last bits depend on where a vector stands, only leaves out what is
        clearly too far. What decides is an exactly rounded sum per vector, so that equal vectors tie in all blocks.
        """
        near = self.x[rows] @ q
        if len(near) > k + 1:
            near_enough = np.partition(near, len(near) - k - 1)[len(near) - k - 1] - 1e-9
            rows = rows[near >= near_enough]
        found = []
        for r in rows.tolist():
            score = min(1.0, max(-1.0, math.fsum((self.x[r] * q).tolist())))
            found += [(-score, i) for i in self.members[r].tolist() if i != query]
        return sorted(found)[:k]


def search_block(block: Block, ids: np.ndarray, x: np.ndarray, coder: Coder, k: int) -> list[tuple[int, int, float]]:
    out = []
    for query, q, code in zip(ids.tolist(), unit(x), coder.codes(x), strict=True):
        radius = coder.radius
        while True:
            rows = block.within(code, radius)
            # One of those found may be the query's own.
            if radius >= BITS or block.sizes[rows].sum() > k:
                break
            radius = min(2 * radius + 1, BITS)
        out += [(query, i, -minus) for minus, i in block.best(rows, query, q, k)]
    return out


FOUND = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}


def searched(group: pa.Table, coder: Coder, k: int) -> pa.Table:
    """What the asking rows of a group find among the others."""
    asks = np.array(group.column("asks").to_pylist(), bool)
    ids, x = group.column("vec_id").to_numpy(), matrix(group.column("embedding"))
    found = []
    if asks.any() and not asks.all():
        found = search_block(Block(ids[~asks], x[~asks], coder, k), ids[asks], x[asks], coder, k)
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, FOUND.values(), strict=True)], names=list(FOUND))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest other vectors found, by cosine in double precision.

    Rows have ``vec_id`` and ``embedding``; rows where ``is_query`` holds ask, all
    rows answer but the query's own (its vec_id). Vectors without a direction take no part, nor do rows
    without vec_id. Vectors meet those of their own length only. A length of up to ``block`` rows is one block, whose
    queries compare all its codes; of every longer one a coder is learned from a bounded sample.
    Every row is indexed, in blocks of about ``block`` vectors chosen by hash, which also spreads equal vectors. Queries meet
    each block of the index in groups of the same size. A block gives every code within the
    radius, learned so that a sample's true neighbours lie inside; where that is ``k`` or fewer
    the radius is doubled, up to the whole code. The survivors are ranked by the vectors
    themselves, nearest first, ties to the smaller vec_id. Repeated vec_ids answer as one, with their best score.
    Other columns are not looked at; an empty table gives no row.
    """
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = stage(rows.withColumn("dim", F.size("embedding")), "vectors")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"))
    # At most one length for every ``block`` rows has more than that.
    large = sizes.where(F.col("n") > block).orderBy("dim").collect()
    schema = "query_id long, vec_id long, score double"

    def whole(group: pa.Table) -> pa.Table:
        # All rows answer, and those that ask do so a second time.
        asking = group.filter(group.column("asks"))
        answers = group.set_column(group.column_names.index("asks"), "asks", pa.array([False] * group.num_rows))
        return searched(pa.concat_tables([answers, asking]), Coder.all_of(group), k)

    few = rows.join(sizes.where(F.col("n") <= block).select("dim"), "dim", "left_semi")
    found = few.groupBy("dim").applyInArrow(whole, schema)
    for r in large:
        found = found.unionAll(_of_length(rows.where(F.col("dim") == r["dim"]), r["dim"], r["n"], r["q"], k, block, schema))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _of_length(rows: DataFrame, dim: int, n: int, n_queries: int, k: int, block: int, schema: str) -> DataFrame:
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, SAMPLE / n))))
    sample = drawn.select("vec_id", "embedding").orderBy("vec_id", "embedding").limit(2 * SAMPLE).collect() or [rows.first()]
    coder = rows.sparkSession.sparkContext.broadcast(learn(np.array([r["embedding"] for r in sample]).reshape(-1, dim), k))
    blocks, groups = max(1, -(-n // block)), max(1, -(-n_queries // block))
    deal = lambda parts, *salt: F.pmod(F.xxhash64("vec_id", "embedding", *salt), F.lit(parts)).cast("int")
    spread = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    index = rows.select("vec_id", "embedding", F.lit(False).alias("asks"), deal(blocks).alias("i"), spread(groups).alias("j"))
    asked = rows.where("asks").select("vec_id", "embedding", "asks", spread(blocks).alias("i"), deal(groups, F.lit(2)).alias("j"))

    def run(group: pa.Table) -> pa.Table:
        return searched(group, coder.value, k)

    return index.unionAll(asked).groupBy("i", "j").applyInArrow(run, schema)
