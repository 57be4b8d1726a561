"""Language-model scoring by context-tree weighting over binary-decomposed bytes."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import map_texts
from readloom.operators.staging import stage, staging_path

#: Bytes of context of the deepest nodes.
DEPTH = 5
#: Bytes of text that one task holds, and that one numpy step counts or scores.
BLOCK = 16 << 20
STEP = 1 << 20
SCORE_STEP = 256 << 10
#: Grams that a task weighs at once; a context with more is split by the byte before it.
SHARD = 100_000
#: Parts of all grams and words, and the blocks whose share in one part is as much as one block holds.
PARTS = 64
PART_BLOCKS = 4
#: Shards of the tree begin at this depth, or deeper where a context is split.
CUT = 2
END = b"\n"


def packer() -> Callable[[list[str]], list[Iterable]]:
    """Texts as their shuffle moves them; both shuffles of texts would otherwise be most of the disk used."""
    compress = zstandard.ZstdCompressor(level=1).compress
    return lambda texts: [[compress(t.encode("utf-8")) for t in texts]]


def unpacked(docs: pa.Table) -> Iterator[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return (expand(x) for x in docs.column("packed").to_pylist())


def body(text: bytes) -> tuple[list[bytes], bytes]:
    """Words, A-Z lowered, and what the model reads: the words with single blanks between and an end."""
    words = text.lower().split()
    return words, b" ".join(words) + END


def codes_of(texts: list[bytes]) -> np.ndarray:
    """For each byte of each text, the byte under its ``DEPTH`` predecessors; a text starts after ends."""
    raw = np.frombuffer(b"".join([END * DEPTH + t for t in texts]), np.uint8)
    codes = np.zeros(len(raw), np.int64)
    for k in range(DEPTH + 1):
        codes[k:] |= raw[: len(raw) - k].astype(np.int64) << (8 * k)
    keep = np.ones(len(raw), bool)
    starts = np.cumsum([0, *[len(t) + DEPTH for t in texts[:-1]]])
    keep[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    return codes[keep]


def steps(texts: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes."""
    at = np.cumsum([len(t) for t in texts]) // size
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(texts)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by 8; right to about 1e-12."""
    y, low = x + 8, np.ones_like(x)
    for k in range(8):
        low = low * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov estimate of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def bit_nodes(codes: np.ndarray, depth: int) -> np.ndarray:
    """Node of each of the 8 bits of each code's byte, ``(n, 8)``: context of ``depth`` bytes, and a 1 before the bits so far."""
    symbol = codes & 255
    context = (codes >> 8) & ((1 << (8 * depth)) - 1)
    k = np.arange(8)
    return context[:, None] << 8 | 1 << k | symbol[:, None] >> (8 - k)


def bits_of(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] & 255) >> (7 - np.arange(8)) & 1


def above(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The node of ``depth`` over each node that is one or more deeper."""
    return (nodes >> 8 & ((1 << (8 * depth)) - 1)) << 8 | nodes & 255


class Level:
    """The nodes of one depth under a set of codes: counts, estimate, and the weight of the own estimate in the mixture."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, depth: int, below: Level | None) -> None:
        nodes = bit_nodes(codes, depth)
        self.keys, at = np.unique(nodes.ravel(), return_inverse=True)
        self.at = at.reshape(nodes.shape)
        ones = bits_of(codes) * n[:, None]
        self.ones = np.bincount(at.ravel(), ones.ravel(), len(self.keys))
        self.zeros = np.bincount(at.ravel(), np.broadcast_to(n[:, None], nodes.shape).ravel(), len(self.keys)) - self.ones
        own = log_kt(self.zeros, self.ones)
        if below is None:
            self.log_weighted, self.own_share = own, np.ones(len(own))
        else:
            children = np.bincount(np.searchsorted(self.keys, above(below.keys, depth)), below.log_weighted, len(self.keys))
            self.log_weighted = np.logaddexp(own, children) - np.log(2)
            self.own_share = share(own, children)


def share(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against the product of its children, each with half the prior."""
    return 1 / (1 + np.exp(np.clip(children - own, -700, 700)))


def mix(below: np.ndarray | None, zeros: np.ndarray, ones: np.ndarray, own_share: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Probability of the bits at a depth, from those one deeper (nan where that context was never met)."""
    seen = zeros + ones
    own = (np.where(bits == 1, ones, zeros) + 0.5) / (seen + 1)
    deeper = np.full(bits.shape, np.nan) if below is None else below
    mixed = np.where(np.isnan(deeper), own, own_share * own + (1 - own_share) * deeper)
    return np.where(seen > 0, mixed, np.nan)


def tree(codes: np.ndarray, n: np.ndarray, cut: int) -> list[Level]:
    """Levels from ``DEPTH`` up to ``cut``."""
    levels: list[Level] = []
    for depth in range(DEPTH, cut - 1, -1):
        levels.append(Level(codes, n, depth, levels[-1] if levels else None))
    return levels


def roots_of(shard: pa.Table) -> pa.Table:
    """The uppermost level of a shard, to be summed into the nodes above it."""
    codes, n, cut = shard.column("gram").to_numpy(), shard.column("n").to_numpy(), shard.column("cut")[0].as_py()
    top = tree(codes, n, cut)[-1]
    depth = pa.array(np.full(len(top.keys), cut - 1), pa.int32())
    return pa.table({"depth": depth, "node": above(top.keys, cut - 1), "zeros": top.zeros, "ones": top.ones, "weighted": top.log_weighted})


class Upper:
    """Nodes of one depth above the shards, from what their children sum to; the last node is none, for those never met."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> None:
        self.keys, at = np.unique(np.append(nodes, np.iinfo(np.int64).max), return_inverse=True)
        self.zeros, self.ones, children = (np.bincount(at, np.append(x, 0.0)) for x in (zeros, ones, children))
        own = log_kt(self.zeros, self.ones)
        self.log_weighted = np.logaddexp(own, children) - np.log(2)
        self.own_share = share(own, children)

    def of(self, nodes: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.keys, nodes)
        at = np.where(self.keys[at] == nodes, at, len(self.keys) - 1)
        return [self.zeros[at], self.ones[at], self.own_share[at]]


def upper_levels(depth: np.ndarray, *sums: np.ndarray) -> list[Upper]:
    """Levels from the deepest above a shard to the root, last; ``sums`` has nodes, zeros, ones and what their children in shards weigh."""
    levels: list[Upper] = []
    for d in range(DEPTH - 1, -1, -1):
        here = [x[depth == d] for x in sums]
        if levels:
            low = levels[-1]
            inner = above(low.keys[:-1], d), low.zeros[:-1], low.ones[:-1], low.log_weighted[:-1]
            here = [np.concatenate(x) for x in zip(here, inner, strict=True)]
        levels.append(Upper(*here))
    return levels


def gram_scores(codes: np.ndarray, n: np.ndarray, cut: int, upper: list[Upper]) -> np.ndarray:
    """log10 of the mixed probability of each code's byte in its context."""
    bits, p = bits_of(codes), None
    for level in tree(codes, n, cut):
        at = level.at
        p = mix(p, level.zeros[at], level.ones[at], level.own_share[at], bits)
    nodes = level.keys
    for depth in range(cut - 1, -1, -1):
        nodes = above(nodes, depth)
        zeros, ones, own = upper[DEPTH - 1 - depth].of(nodes)
        p = mix(p, zeros[at], ones[at], own[at], bits)
    return np.log10(np.where(np.isnan(p), 0.5, p)).sum(axis=1)


def summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of several lists in order, with the sums of their counts."""
    grams, n = np.concatenate([g for g, _ in counts]), np.concatenate([m for _, m in counts])
    order = np.argsort(grams, kind="stable")
    grams, n = grams[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.add.reduceat(n, first)


def gram_parts(grams: np.ndarray, parts: int) -> np.ndarray:
    """Part of each gram, by a multiplicative hash."""
    return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(parts)


def in_parts(values: pa.Array, n: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """The parts that occur, and for each a list of its values and one of their counts."""
    order = np.argsort(part, kind="stable")
    found, sizes = np.unique(part, return_counts=True)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, x.take(pa.array(order))) for x in (values, pa.array(n, pa.int64()))]
    return found, *lists


def block_statistics(parts: int) -> Callable[[pa.Table], pa.Table]:
    """Distinct grams and words of a block, each with its number in training texts, as a row for each part."""

    def run(docs: pa.Table) -> pa.Table:
        learn = np.array(docs.column("learn").to_pylist(), bool)
        texts, counts, words, unused = [], [], Counter(), set()
        for text, use in zip(unpacked(docs), learn.tolist(), strict=True):
            own, read = body(text)
            texts.append(read)
            words.update(own) if use else unused.update(own)
            words[END] += use
        words.update(dict.fromkeys(unused, 0))
        for i, j in steps(texts, STEP):
            # The lowest bit tells training texts, so one sort counts both.
            used = np.repeat(learn[i:j], [len(t) for t in texts[i:j]])
            grams, n = np.unique(codes_of(texts[i:j]) << 1 | used, return_counts=True)
            counts.append((grams >> 1, n * (grams & 1)))
            if len(counts) == 4:
                counts = [summed(counts)]
        grams, n = summed(counts)
        of_words = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
        gram_part, gram_lists, gram_n = in_parts(pa.array(grams), n, gram_parts(grams, parts))
        word_part, word_lists, word_n = in_parts(pa.array(list(words), pa.binary()), np.fromiter(words.values(), np.int64, len(words)), of_words)
        a, b = len(gram_part), len(word_part)
        columns = {
            "block": pa.array(np.full(a + b, docs.column("block")[0].as_py()), pa.int32()),
            "part": pa.array(np.concatenate([gram_part, word_part]), pa.int32()),
            "grams": pa.chunked_array([gram_lists, pa.nulls(b, gram_lists.type)]),
            "words": pa.chunked_array([pa.nulls(a, word_lists.type), word_lists]),
            "n": pa.chunked_array([gram_n, word_n]),
            "kind": pa.array(["gram"] * a + ["word"] * b),
        }
        return pa.table(columns)

    return run


def lists_of(table: pa.Table, name: str) -> tuple[pa.Array, pa.Array]:
    """Where the list of each row ends in all values (after a 0), and these."""
    lists = table.column(name).combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), lists.flatten()


def sum_grams(part: pa.Table) -> pa.Table:
    """Distinct grams of a part of all blocks, with their number in the corpus."""
    grams, n = summed([(lists_of(part, "grams")[1].to_numpy(), lists_of(part, "n")[1].to_numpy())])
    return pa.table({"gram": grams, "n": n})


def count_words(part: pa.Table) -> pa.Table:
    """For each block its words of a part with their number in the corpus; the first row also has the part's totals."""
    ends, words = lists_of(part, "words")
    coded = words.dictionary_encode()
    at = coded.indices.to_numpy()
    n = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(n, at, lists_of(part, "n")[1].to_numpy())
    totals = np.zeros((2, part.num_rows), np.int64)
    totals[:, 0] = n.sum(), (n > 0).sum()
    lists = [pa.ListArray.from_arrays(ends, x) for x in (words, pa.array(n[at]))]
    return pa.table([part.column("block"), *lists, *map(pa.array, totals)], names=["block", "words", "counts", "tokens", "distinct"])


def look_up(part: pa.Table, values: pa.Table) -> pa.Table:
    """For each block its grams of a part with their values."""
    ends, grams = lists_of(part, "grams")
    known = values.column("gram").to_numpy()
    order = np.argsort(known)
    log_p = values.column("value").to_numpy()[order][np.searchsorted(known[order], grams.to_numpy())]
    return pa.table({"block": part.column("block"), **{k: pa.ListArray.from_arrays(ends, x) for k, x in (("grams", grams), ("log_p", pa.array(log_p)))}})


def score_block(train_tokens: int, n_distinct: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return OUT.empty_table()
        of = lambda name: lists_of(known, name)[1]
        grams, log_p = of("grams").to_numpy(), of("log_p").to_numpy().astype(np.float64)
        order = np.argsort(grams)
        grams, log_p = grams[order], log_p[order]
        words, n = of("words").to_pylist(), of("counts").to_numpy()
        at_of = dict(zip(words, range(len(words)), strict=True))
        base_of = np.log10(n + 1) - np.log10(train_tokens + n_distinct + 1)
        texts, tokens, n_known, base, sums = [], [], [], [], []
        for text in unpacked(docs):
            own, read = body(text)
            own.append(END)
            texts.append(read)
            at = np.array([at_of[x] for x in own])
            tokens.append(len(own))
            n_known.append(int((n[at] > 0).sum()))
            base.append(float(base_of[at].sum()))
        for i, j in steps(texts, SCORE_STEP):
            own, at = np.unique(codes_of(texts[i:j]), return_inverse=True)
            p = log_p[np.searchsorted(grams, own)][at]
            sums.append(np.add.reduceat(p, np.cumsum([0, *[len(t) for t in texts[i : j - 1]]])))
        score = np.concatenate(sums)
        per_byte = -score * np.log2(10) / np.array([len(t) for t in texts])
        return pa.table(
            [docs.column("doc_id"), *map(pa.array, (tokens, n_known, base, score, per_byte))],
            schema=OUT,
        )

    return run


OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
)


def in_shards(grams: DataFrame, size: int) -> DataFrame:
    """Grams with ``cut`` and ``shard``: all under one context of ``cut`` bytes are together, and no more than ``size``.

    A context with more is split by the byte before it; only these, at most a ``size``-th of the grams for each
    depth, are listed on the driver.
    """
    context = lambda depth: F.shiftright("gram", 8).bitwiseAND((1 << (8 * depth)) - 1)
    total, cut, large, rest = 0, F.lit(DEPTH), [], grams
    for depth in range(CUT, DEPTH):
        counted = rest.groupBy(context(depth).alias("context")).count()
        n, listed = counted.agg(F.sum("count"), F.collect_list(F.when(F.col("count") > size, F.col("context")))).first()
        total = total or n or 0
        large.append((depth, listed))
        if not listed:
            break
        rest = rest.where(context(depth).isin(listed))
    for depth, listed in reversed(large):
        cut = F.when(context(depth).isin(listed), cut).otherwise(depth) if listed else F.lit(depth)
    own = F.lit(None)
    for depth in range(CUT, DEPTH + 1):
        own = F.when(F.col("cut") == depth, context(depth)).otherwise(own)
    shards = max(1, -(-total // size))
    return grams.withColumn("cut", cut.cast("int")).withColumn("shard", F.pmod(F.xxhash64(own), F.lit(shards)).cast("int"))


def score(docs: DataFrame, learn: Column, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`` for every row.

    The model reads a text as its words (ASCII white space apart, A-Z lowered) with
    single blanks and an end. Each byte is eight binary decisions; a node of the tree
    is a context of 0 to ``DEPTH`` bytes and the bits so far. Its weighted probability
    is half its Krichevsky-Trofimov estimate and half the product of its children's, over
    the rows where ``learn`` is true, so all depths are mixed by what they are worth.
    A context that was never met ends the path. ``score`` is the log10 probability of the
    text (each byte's part in single precision, their sum in double), ``bits_per_byte`` its code length. ``base_score`` is the add-one unigram score of the words and an end.

    Texts are dealt by hash to blocks of about ``block`` bytes. A block sends its
    distinct grams (byte and context) and words with their counts, a list to each part of all grams and words;
    parts, by hash, sum them over the corpus. The tree is weighted in shards of whole contexts: of two bytes, or
    more where one has over ``shard`` grams. Each block gets back from the parts only what it holds. Only the nodes above
    shards pass through the driver: at most 65,792 of depth 0 and 1, and 255 for each context that is split.
    Null texts are empty; a null ``learn`` is false; repeated rows count as often as they occur.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    dealt = map_texts(dealt, ["doc_id", "learn", "block"], packer, {"packed": "binary"})
    parts = max(PARTS, -(-blocks // PART_BLOCKS))
    stats = dealt.groupBy("block").applyInArrow(
        block_statistics(parts), "block int, part int, grams array<long>, words array<binary>, n array<long>, kind string"
    )
    # Grams and words in files of their own, as grams are read twice.
    stats.write.partitionBy("kind").parquet(path := staging_path(docs.sparkSession, "statistics"))
    stats = docs.sparkSession.read.schema(stats.schema).parquet(path)
    block_grams = stats.where("kind = 'gram'").select("block", "part", "grams", "n")
    block_words = stats.where("kind = 'word'").select("block", "part", "words", "n")

    words = block_words.groupBy("part").applyInArrow(
        count_words, "block int, words array<binary>, counts array<long>, tokens long, distinct long"
    )
    words = stage(words, "words")
    totals = words.agg(F.sum("tokens"), F.sum("distinct")).first()
    train_tokens, n_distinct = totals[0] or 0, totals[1] or 0

    grams = block_grams.groupBy("part").applyInArrow(sum_grams, "gram long, n long")
    grams = stage(grams, "grams")
    grams = in_shards(grams, shard)
    trained = grams.where("n > 0").groupBy("cut", "shard")
    sums = trained.applyInArrow(roots_of, "depth int, node long, zeros double, ones double, weighted double").groupBy("depth", "node")
    sums = sums.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted")).toPandas()
    of = lambda name, kind: sums[name].to_numpy(kind)
    upper = docs.sparkSession.sparkContext.broadcast(
        upper_levels(of("depth", np.int64), of("node", np.int64), *(of(c, np.float64) for c in ("zeros", "ones", "weighted")))
    )

    def weigh(part: pa.Table) -> pa.Table:
        codes = part.column("gram").to_numpy()
        value = gram_scores(codes, part.column("n").to_numpy(), part.column("cut")[0].as_py(), upper.value)
        return pa.table({"part": pa.array(gram_parts(codes, parts), pa.int32()), "gram": codes, "value": value.astype(np.float32)})

    values = grams.groupBy("cut", "shard").applyInArrow(weigh, "part int, gram long, value float")
    known = block_grams.select("block", "part", "grams").groupBy("part").cogroup(values.groupBy("part"))
    known = known.applyInArrow(look_up, "block int, grams array<long>, log_p array<float>")
    back = known.unionByName(words.select("block", "words", "counts"), allowMissingColumns=True)
    found = dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        score_block(train_tokens, n_distinct),
        "doc_id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double",
    )
    return found.withColumn("train_tokens", F.lit(train_tokens).cast("long"))
