"""Merkle manifest of a dataset as a persistent tree: every tampered row is a version that copies only its ancestors."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.ordering import ranked
from readloom.operators.staging import stage

#: Nodes that become one parent.
ARITY = 16
#: Levels that a task folds at once, and the nodes of such an aligned block.
LEVELS = 2
BLOCK = ARITY**LEVELS
#: Columns of a row that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
KEY = ["tree", "block"]
STEP = "struct<before:string,after:string>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """sha256 of the columns, each as ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    shown = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in shown]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def fold(nodes: list[str], levels: int | None = None) -> list[list[str]]:
    """The levels over a block, itself first: up to a single node, or exactly ``levels`` more."""
    found = [nodes]
    while len(found) <= levels if levels is not None else len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return found


def steps(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """Siblings to the left and to the right of the path from a node of a block to its top."""
    path = []
    for nodes in levels[:-1]:
        first = place // ARITY * ARITY
        path.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + ARITY])))
        place //= ARITY
    return path


def climb(node: str, path: Sequence[tuple[str, str]]) -> list[str]:
    """A node and its ancestors, recomputed from the siblings along its path."""
    found = [node]
    for before, after in path:
        found.append(digest((before, found[-1], after)))
    return found


def in_order(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("place")


def fold_blocks(key, nodes):
    """One row per block: its top if the tree has no other block (``whole``), and ``LEVELS`` up if it has (``part``)."""
    digests = in_order(nodes).column("digest").to_pylist()
    tops = [[fold(digests)[-1][0]], [fold(digests, LEVELS)[-1][0]]]
    return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "whole": tops[0], "part": tops[1]})


@dataclass
class Tier:
    """Nodes of one pass with the block of each, and the tree, block and top of all blocks; ``last`` block 0: a whole tree."""

    nodes: DataFrame
    blocks: DataFrame


def build(leaves: DataFrame) -> tuple[list[Tier], DataFrame]:
    """All tiers over ``(tree, place, digest)``, and ``(tree, top)`` of every tree.

    A pass folds aligned blocks of ``BLOCK`` nodes in tasks and keeps a node per block,
    so a tree of n leaves takes log(n) / log(BLOCK) passes and no task sees more than a block.
    """
    tiers: list[Tier] = []
    tops = None
    nodes = leaves
    while True:
        nodes = nodes.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
        folded = nodes.select(*KEY, "place", "digest").groupBy(*KEY)
        blocks = stage(folded.applyInArrow(fold_blocks, "tree string, block long, whole string, part string"), "blocks")
        last = blocks.groupBy("tree").agg(F.max("block").alias("last"))
        blocks = blocks.join(last, "tree")
        tiers.append(Tier(nodes, blocks))
        done = blocks.where(F.col("last") == 0).select("tree", F.col("whole").alias("top"))
        tops = done if tops is None else tops.unionAll(done)
        above = blocks.where(F.col("last") > 0)
        nodes = stage(above.select("tree", F.col("block").alias("place"), F.col("part").alias("digest")), "nodes")
        if nodes.isEmpty():
            return tiers, tops


def paths_above(tiers: list[Tier], ends: DataFrame) -> DataFrame:
    """``(tree, block, last, path)``: the siblings from the top of each block of the first tier up to the root.

    ``ends`` is ``(tree, path)``, what lies over each tree. Walked from the last tier
    down, a tier's blocks take the path of their node in the tier above.
    """

    def extend(key, nodes, above):
        nodes = in_order(nodes)
        places, digests = nodes.column("place").to_pylist(), nodes.column("digest").to_pylist()
        rest, last = above.column("path").to_pylist()[0], above.column("last").to_pylist()[0]
        levels = fold(digests, None if last == 0 else LEVELS)
        paths = [[{"before": b, "after": a} for b, a in steps(levels, i)] + rest for i in range(len(places))]
        out = {"tree": [key[0].as_py()] * len(places), "place": places, "path": paths}
        return pa.table(out, pa.schema([("tree", pa.string()), ("place", pa.int64()), ("path", PATH)]))

    above = None
    for tier in reversed(tiers):
        found = tier.blocks.where(F.col("last") == 0).join(ends, "tree").select(*KEY, "last", "path")
        if above is not None:
            inner = tier.blocks.where(F.col("last") > 0).join(
                above.withColumnRenamed("place", "block"), KEY
            )
            found = found.unionAll(inner.select(*KEY, "last", "path"))
        found = stage(found, "above")
        if tier is not tiers[0]:
            pair = tier.nodes.select(*KEY, "place", "digest").groupBy(*KEY).cogroup(found.groupBy(*KEY))
            above = pair.applyInArrow(extend, f"tree string, place long, path array<{STEP}>")
    return found


PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
NODE = pa.struct([("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string())])
RESULT = {
    "doc_id": "long",
    "leaf": "string",
    "subroot": "string",
    "root": "string",
    "proof_sha256": "string",
    "folded_root": "string",
    "verified": "boolean",
    "version": "array<struct<level:int,place:bigint,digest:string>>",
}
ARROW = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(NODE)]


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, version)``, one row per row of ``docs``.

    A leaf is ``leaf_digest`` of ``FIELDS``; a source's leaves, by doc_id, fold 16 to a
    parent up to its subroot, and the subroots, by source with null first, to the root.
    ``proof_sha256`` covers a row's siblings on the way to the root. Where ``tampered``
    holds (by default where 5 divides the crc32 of the id), the row's A-Z are lowered in a
    version of its own: ``version`` lists the nodes that it copies, the leaf and its ancestors,
    as ``(level, place, digest)``. All other nodes are shared with the tree; levels over the
    subroot count on, their places are those among the sources. ``folded_root`` is the version's
    root, or the root recomputed from the row's own leaf where nothing is tampered with.

    A null in any column is ``-`` in its leaf; rows with a null id come first in their source and are not
    tampered with by default. Rows that repeat are leaves of their own, ordered by leaf where ids are
    equal. Empty texts, texts of any length and texts without A-Z are leaves as all others (the last
    verify). An empty table gives no row. Other columns of ``docs`` are not looked at.

    Texts are hashed where they lie; only digests are sorted (by range, so a source that holds most
    rows splits), folded by aligned block and, below the top of a block, hashed a second time for the proofs.
    """
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    plain = [F.col(c) for c in FIELDS]
    rows = docs.select(
        # Ascending strings put the null source first.
        F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(plain).alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_digest([*plain[:-1], lowered(F.col("text"))])).alias("changed"),
    )
    leaves = ranked(stage(rows, "leaves"), ["doc_id", "digest"], group=["tree"], name="place")
    leaves = stage(leaves.withColumn("place", F.col("place") - 1), "placed_leaves")
    tiers, subroots = build(leaves.select("tree", "place", "digest"))
    subroots = stage(subroots, "subroots")
    sources = ranked(subroots, ["tree"], name="place").withColumn("place", F.col("place") - 1)
    sources = stage(sources.select("tree", "place", F.col("top").alias("digest")), "sources")
    upper, roots = build(sources.select(F.lit("").alias("tree"), "place", "digest"))
    nothing = F.array().cast(f"array<{STEP}>")
    over = paths_above(upper, roots.select("tree", nothing.alias("path")))
    over = over.join(roots.select("tree", F.col("top").alias("root")), "tree")
    # Every source climbs from its own place in its block to the root.
    numbered = sources.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long")).withColumnRenamed("tree", "name")
    pair = numbered.groupBy("block").cogroup(over.drop("tree").groupBy("block"))
    schema = f"tree string, place long, subroot string, root string, path array<{STEP}>"
    ends = stage(pair.applyInArrow(source_paths, schema), "ends")
    above = paths_above(tiers, ends.select("tree", "path"))
    above = above.join(ends.select("tree", F.col("place").alias("source_place"), "subroot", "root"), "tree")
    leaves = leaves.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
    schema = ", ".join(f"{n} {t}" for n, t in RESULT.items())
    return leaves.groupBy(*KEY).cogroup(above.groupBy(*KEY)).applyInArrow(prove, schema)


def source_paths(key, sources, over):
    sources = in_order(sources)
    subroots, places = sources.column("digest").to_pylist(), sources.column("place").to_pylist()
    levels = fold(subroots, None if over.column("last").to_pylist()[0] == 0 else LEVELS)
    rest = over.column("path").to_pylist()[0]
    paths = [[{"before": b, "after": a} for b, a in steps(levels, i)] + rest for i in range(len(places))]
    roots = over.column("root").to_pylist()[:1] * len(places)
    columns = [sources.column("name"), pa.array(places), pa.array(subroots), pa.array(roots), pa.array(paths, PATH)]
    return pa.table(columns, names=["tree", "place", "subroot", "root", "path"])


def prove(key, leaves, above):
    """The result rows of one block of leaves: local siblings from the block, the others from ``above``."""
    leaves = in_order(leaves)
    digests, changed = leaves.column("digest").to_pylist(), leaves.column("changed").to_pylist()
    places = leaves.column("place").to_pylist()
    up = {name: above.column(name).to_pylist()[0] for name in above.column_names}
    rest = [(s["before"], s["after"]) for s in up["path"]]
    siblings = "".join(b + a for b, a in rest)
    levels = fold(digests, None if up["last"] == 0 else LEVELS)
    depth = len(levels) - 1 + _levels_left(up["block"], up["last"])
    proofs, folded, versions = [], [], []
    for i, (leaf, new) in enumerate(zip(digests, changed, strict=True)):
        path = steps(levels, i)
        proofs.append(digest([*(b + a for b, a in path), siblings]))
        nodes = climb(leaf if new is None else new, path + rest)
        folded.append(nodes[-1])
        versions.append(None if new is None else list(_copied(nodes, places[i], up["source_place"], depth)))
    n = len(digests)
    columns = [
        leaves.column("doc_id").combine_chunks(),
        digests,
        [up["subroot"]] * n,
        [up["root"]] * n,
        proofs,
        folded,
        [f == up["root"] for f in folded],
        versions,
    ]
    return pa.table([pa.array(c, t) for c, t in zip(columns, ARROW, strict=True)], names=list(RESULT))


def _levels_left(block: int, last: int) -> int:
    """Levels between the tops of the blocks and the subroot, from the number of blocks."""
    n, left = last + 1, 0
    while n > 1:
        n, left = -(-n // ARITY), left + 1
    return left


def _copied(nodes: list[str], place: int, source: int, depth: int) -> Iterator[dict]:
    for level, node in enumerate(nodes):
        at = place // ARITY**level if level <= depth else source // ARITY ** (level - depth)
        yield {"level": level, "place": at, "digest": node}
