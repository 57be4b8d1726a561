"""Embedding near-dedup over navigable small-world graphs, one per shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import components, spanning
from readloom.llm.vectors import matrix, unit, usable
from readloom.operators.staging import stage

THRESHOLD = 0.98
#: Vectors of a shard; links of a node; beam while building and at first while searching.
SHARD = 8192
LINKS = 12
BEAM = 32
#: Queries that are looked for by comparison with a whole shard, and the share of their links that the beam must find.
AUDIT = 64
AUDIT_RECALL = 0.99
#: Rows that numpy handles at once.
STEP = 256


class Graph:
    """Hierarchical small world of unit vectors; layer 0 holds all nodes, each higher one about a ``LINKS``-th."""

    def __init__(self, x: np.ndarray, seed: int = 0) -> None:
        self.x = x.astype(np.float32)
        n = len(x)
        height = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
        self.layers: list[np.ndarray] = []
        self.order = np.argsort(-height, kind="stable")
        self.sizes = [int((height >= k).sum()) for k in range(int(height.max(initial=0)), -1, -1)]
        # Nodes are numbered by falling height, so a layer is a prefix, and lower layers start from the one above.
        self.x = self.x[self.order]
        for size in self.sizes:
            self.layers.append(np.full((size, 2 * LINKS), -1, np.int32))
            done = min(size, STEP)
            self.connect(np.arange(done), 0)
            while done < size:
                batch = np.arange(done, min(size, 2 * done, done + STEP))
                self.connect(batch, done)
                done = int(batch[-1]) + 1

    def connect(self, batch: np.ndarray, done: int) -> None:
        """Link new nodes to near ones among the first ``done`` and among themselves, both ways."""
        layer, q = self.layers[-1], self.x[batch]
        near = q @ q.T
        np.fill_diagonal(near, -2)
        width = min(2 * LINKS, len(batch) - 1)
        own = np.argsort(-near, axis=1)[:, :width]
        ids, score = batch[own], np.take_along_axis(near, own, 1)
        if done:
            found, s = self.search(q, BEAM, len(self.layers) - 1)
            ids, score = np.concatenate([found, ids], 1), np.concatenate([s, score], 1)
        chosen = self.diverse(ids, score)
        layer[batch, :LINKS] = chosen
        left, right = np.repeat(batch, chosen.shape[1]), chosen.ravel()
        left, right = left[right >= 0], right[right >= 0]
        # Back links: nodes that overflow keep the diverse ones of all they have.
        order = np.argsort(right, kind="stable")
        left, right = left[order], right[order]
        nodes, first, n = np.unique(right, return_index=True, return_counts=True)
        wide = np.full((len(nodes), int(n.max(initial=0))), -1, np.int64)
        wide[np.repeat(np.arange(len(nodes)), n), np.arange(len(right)) - np.repeat(first, n)] = left
        for at in range(0, len(nodes), STEP):
            some = nodes[at : at + STEP]
            ids = np.concatenate([layer[some], wide[at : at + STEP]], 1)
            score = np.einsum("bkd,bd->bk", self.x[ids], self.x[some])
            score[ids < 0] = -3
            layer[some] = self.diverse(ids, score, 2 * LINKS)

    def diverse(self, ids: np.ndarray, score: np.ndarray, links: int = LINKS) -> np.ndarray:
        """Per row up to ``links`` ids: near ones that lie closer to the row than to a chosen one first, then the nearest left."""
        order = np.argsort(-score, axis=1, kind="stable")[:, : 2 * links + LINKS]
        ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1).copy()
        rows, width = ids.shape
        repeated = (ids[:, :, None] == ids[:, None, :]) & np.tri(width, width, -1, dtype=bool)
        score[repeated.any(axis=2)] = -3
        usable = score > -2
        vectors = self.x[ids]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        chosen = np.zeros(ids.shape, bool)
        for j in range(width):
            shaded = (chosen[:, :j] & (between[:, j, :j] > score[:, j : j + 1])).any(axis=1)
            chosen[:, j] = usable[:, j] & ~shaded & (chosen.sum(axis=1) < links)
        rank = np.where(chosen, 0, np.where(usable, width, 3 * width)) + np.arange(width)
        best = np.argsort(rank, axis=1, kind="stable")[:, :links]
        out = np.where(np.take_along_axis(usable, best, 1), np.take_along_axis(ids, best, 1), -1)
        return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)

    def search(self, q: np.ndarray, beam: int, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the best ``beam`` nodes met, nearest first (-1 where fewer), down to layer ``last``."""
        last = len(self.layers) - 1 if last is None else last
        start = np.zeros((len(q), 1), np.int64)
        for k in range(last + 1):
            ids, score = self.walk(q, start, k, beam if k == last else min(beam, LINKS))
            start = ids
        return ids, score

    def walk(self, q: np.ndarray, start: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        links, rows = self.layers[layer], np.arange(len(q))[:, None]
        seen = np.zeros((len(q), len(links)), bool)
        ids = np.full((len(q), max(beam, start.shape[1])), -1, np.int64)
        ids[:, : start.shape[1]] = start
        score = np.where(ids >= 0, np.einsum("bkd,bd->bk", self.x[ids], q), -3).astype(np.float32)
        seen[np.broadcast_to(rows, start.shape)[start >= 0], start[start >= 0]] = True
        opened = ids < 0
        while not opened.all():
            # The four best of a beam that were not opened yet, in all beams at once.
            waiting = np.where(opened, -3, score)
            pick = np.argpartition(-waiting, min(3, waiting.shape[1] - 1), axis=1)[:, :4]
            fresh = ~np.take_along_axis(opened, pick, 1)
            np.put_along_axis(opened, pick, True, 1)
            node = np.where(fresh, np.take_along_axis(ids, pick, 1), -1)
            met = np.where(node[:, :, None] >= 0, links[np.maximum(node, 0)], -1).reshape(len(q), -1)
            met = np.sort(met, axis=1)
            met[:, 1:][met[:, 1:] == met[:, :-1]] = -1
            new = (met >= 0) & ~seen[rows, np.maximum(met, 0)]
            seen[np.broadcast_to(rows, met.shape)[new], met[new]] = True
            s = np.full(met.shape, -3, np.float32)
            at, _ = np.nonzero(new)
            s[new] = np.einsum("nd,nd->n", self.x[met[new]], q[at])
            ids = np.concatenate([ids, np.where(new, met, -1)], 1)
            score = np.concatenate([score, s], 1)
            opened = np.concatenate([opened, ~new], 1)
            best = np.argsort(-score, axis=1, kind="stable")[:, :beam]
            ids, score, opened = (np.take_along_axis(a, best, 1) for a in (ids, score, opened))
        return ids, score


def planted(x: np.ndarray, threshold: float) -> np.ndarray:
    """For each unit vector another one at the threshold's cosine to it, in a random direction."""
    side = np.random.default_rng(1).normal(size=x.shape)
    side -= np.einsum("nd,nd->n", side, x)[:, None] * x
    side /= np.maximum(np.sqrt((side * side).sum(axis=1, keepdims=True)), 1e-12)
    return threshold * x + np.sqrt(max(0.0, 1 - threshold * threshold)) * side


def linked(x: np.ndarray, ids: np.ndarray, q: np.ndarray, query_ids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Ends of links that span the components of all pairs found at the threshold, every query against one shard's graph.

    The beam is doubled until an audit passes: of the links of some queries, counted exactly, it must find
    ``AUDIT_RECALL``, and as large a share of ``AUDIT`` nodes of the shard from vectors made at the
    threshold's cosine to them, which exist also where the queries have no link. A beam that is full of links would hide others; for such a
    query it is widened to the whole shard at once, which is one matrix product.
    """
    graph = Graph(x)
    x, ids = x[graph.order], ids[graph.order]
    low = threshold - 1e-4
    audit = np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int)
    truth = q[audit] @ x.T >= threshold
    aim = np.linspace(0, len(x) - 1, min(AUDIT, len(x))).astype(int)
    made = planted(x[aim], threshold)
    better = ((made @ x.T) > np.einsum("nd,nd->n", made, x[aim])[:, None]).sum(axis=1)
    beam = min(BEAM, len(x))
    while beam < len(x):
        found, near = graph.search(q[audit].astype(np.float32), beam)
        roomy = near[:, -1] < low
        hit = np.take_along_axis(truth, np.maximum(found, 0), 1) & (found >= 0)
        met, _ = graph.search(made.astype(np.float32), beam)
        # A node that the shard ranks behind a whole beam can't be in it.
        fair = better < beam
        there = (met == aim[:, None]).any(axis=1)
        if hit[roomy].sum() >= AUDIT_RECALL * truth[roomy].sum() and there[fair].sum() >= AUDIT_RECALL * fair.sum():
            break
        beam = min(2 * beam, len(x))
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(q), STEP):
        part = q[at : at + STEP]
        found, near = graph.search(part.astype(np.float32), beam)
        roomy = near[:, -1] < low
        i, k = np.nonzero((found >= 0) & (near >= low) & roomy[:, None])
        j = found[i, k]
        exact = np.einsum("nd,nd->n", part[i], x[j]) >= threshold
        crowded = np.flatnonzero(~roomy)
        more, others = np.nonzero(part[crowded] @ x.T >= threshold)
        i, j = np.concatenate([i[exact], crowded[more]]), np.concatenate([j[exact], others])
        i, j = query_ids[at : at + STEP][i], ids[j]
        u, v = spanning(np.concatenate([u, i[i != j]]), np.concatenate([v, j[i != j]]))
    return u, v


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """``(vec_id, label, n_links, component_id, kept)``, one row per row of ``(vec_id, embedding, label)``.

    Vectors of one label (null: none) and length link at a cosine of ``threshold`` or more, in
    double precision. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id reachable, ``kept`` is true for that row. Vectors that are null,
    empty, zero or not finite, and rows without vec_id, link with nothing.

    Equal vectors become one node first. The nodes of a label are dealt to shards of
    about ``shard`` by hash; each shard has a graph, and every shard of the label is searched for every node, in
    groups of two shards. A group returns a spanning forest of the links that it found and verified, never its pairs.
    Components are united over all groups. A link joins members of one component, so the
    exact counts come from comparing each component's members, again in blocks of two shards.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    able = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = stage(rows.withColumn("able", able), "vectors")
    nodes = rows.where("able").groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = nodes.withColumn("dim", F.size("embedding"))
    nodes = stage(nodes, "nodes")
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("parts"))
    placed = nodes.join(sizes, ["label", "dim"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def pairs_of(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
        """Each row once as a member of shard i for every j >= i, and once as one of shard j for every i < j."""
        member = df.select(*keys, *columns, F.col("part").alias("i"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("j"), F.lit(True).alias("member"))
        asks = df.where("part > 0").select(*keys, *columns, F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("i"), F.col("part").alias("j"), F.lit(False).alias("member"))
        return member.unionAll(asks).groupBy(*keys, "i", "j")

    def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
        member = np.array(group.column("member").to_pylist(), bool)
        x, ids = unit(matrix(group.column("embedding"))), group.column("node").to_numpy()
        alone = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        ask = member if alone else ~member
        return member, ask, x, ids, alone

    def find(group: pa.Table) -> pa.Table:
        member, ask, x, ids, _ = sides(group)
        u, v = linked(x[member], ids[member], x[ask], ids[ask], threshold) if member.any() and ask.any() else ([], [])
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(v, pa.int64())})

    found = components(pairs_of(placed, ["label", "dim"], ["node", "embedding"]).applyInArrow(find, "a long, b long"))
    found = stage(found.select(F.col("id").alias("node"), F.col("component_id").alias("component")), "components")

    # Exact counts inside components of more than one node.
    inner = nodes.join(found, "node").select("component", "node", "copies", "embedding", "dim")
    crowd = inner.groupBy("component").agg(F.ceil(F.count("*") / shard).cast("int").alias("parts"))
    inner = inner.join(crowd, "component").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # Small components share a group; a component of one shard keeps to its own rows by its number.
    inner = inner.withColumn("bag", F.when(F.col("parts") > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(max(1, -(-2 * found.count() // shard))))))
    inner = inner.withColumn("large", F.col("parts") > 1)

    def count(group: pa.Table) -> pa.Table:
        member, ask, x, ids, alone = sides(group)
        component, copies = group.column("component").to_numpy(), group.column("copies").to_numpy()
        left, right = np.flatnonzero(member), np.flatnonzero(ask)
        out = np.zeros(len(ids), np.int64)
        right = right[np.argsort(component[right], kind="stable")]
        left = left[np.argsort(component[left], kind="stable")]
        starts = np.searchsorted(component[left], component[right], "left")
        stops = np.searchsorted(component[left], component[right], "right")
        for lo, hi in sorted(set(zip(starts.tolist(), stops.tolist(), strict=True))):
            mates = right[np.searchsorted(starts, lo) : np.searchsorted(starts, lo, "right")]
            mates = mates[component[mates] == component[left[lo]]] if lo < hi else mates[:0]
            own = left[lo:hi]
            for at in range(0, len(mates), STEP):
                some = mates[at : at + STEP]
                near = x[some] @ x[own].T >= threshold
                if alone:
                    near &= ids[some][:, None] != ids[own][None, :]
                out[some] += near @ copies[own]
                if not alone:
                    out[own] += copies[some] @ near
        return pa.table({"node": ids, "n": out})

    columns = ["component", "node", "copies", "embedding"]
    direct = pairs_of(inner, ["large", "bag", "dim"], columns).applyInArrow(count, "node long, n long")
    direct = direct.groupBy("node").agg(F.sum("n").alias("n"))
    named = nodes.join(found, "node", "left").join(direct, "node", "left").select(
        F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), "node", "component", "copies", "n"
    )
    same = F.col("able") & (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    component = F.coalesce("component", "node", "vec_id")
    return rows.join(named, same, "left").select(
        "vec_id",
        "label",
        (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
