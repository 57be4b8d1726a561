"""SimHash near-dedup whose candidates come from Golay-decoded segments of the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import components, map_texts, spanning, words_of
from readloom.operators.staging import stage

SEED = 42
#: Low bit and width of the three segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of a key up to which a plain join compares them; above, blocks do.
SMALL_BUCKET = 8
#: Fingerprints in a block of a large bucket.
BLOCK = 2048
#: Generator of the perfect binary Golay code of length 23, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0xAE3


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    plain, size = b" ".join(words), min(shingle, len(words))
    stops = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], stops[:-1]])
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    hashes = np.fromiter(
        (digest(plain[i:j], SEED) for i, j in zip(starts[:n].tolist(), (stops[size - 1 :] - 1).tolist())), np.uint64, n
    )
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """The ``keep`` columns of every row and ``fp``, the 64 bits as a long."""

    def start():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, keep, start, {"fp": "long"})


def golay_errors() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each bit, and the error of up to 3 bits that belongs to each of the 2,048 syndromes."""
    rest = np.zeros(23, np.int64)
    for i in range(23):
        value = 1 << i
        for bit in range(22, 10, -1):
            if value >> bit & 1:
                value ^= GENERATOR << (bit - 11)
        rest[i] = value
    errors = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            errors[np.bitwise_xor.reduce(rest[list(bits)])] = sum(1 << b for b in bits)
    return rest, errors


REST, ERRORS = golay_errors()


def codeword(values: np.ndarray) -> np.ndarray:
    """12-bit number of the codeword nearest to each 23-bit word."""
    syndrome = np.zeros(values.shape, np.int64)
    for bit in range(23):
        syndrome ^= (values >> bit & 1) * REST[bit]
    return (values ^ ERRORS[syndrome]) >> 11


def segments_of(fp: np.ndarray) -> list[np.ndarray]:
    bits = fp.view(np.uint64)
    return [(bits >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]


def own_keys(fp: np.ndarray) -> np.ndarray:
    """One key per pair of segments: the codewords nearest to both."""
    words = [codeword(s) for s in segments_of(fp)]
    return np.stack([p << 24 | words[i] << 12 | words[j] for p, (i, j) in enumerate(combinations(range(3), 2))], axis=1)


def near_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)``: every key that a fingerprint with at most one other bit in both segments can own."""
    near = []
    for s, (_, width) in zip(segments_of(fp), SEGMENTS, strict=True):
        words = np.sort(codeword(np.stack([s, *(s ^ (1 << b) for b in range(width))], axis=1)), axis=1)
        first = np.ones(words.shape, bool)
        first[:, 1:] = words[:, 1:] != words[:, :-1]
        order = np.argsort(~first, axis=1, kind="stable")
        most = int(first.sum(axis=1).max(initial=1))
        near.append((np.take_along_axis(words, order, 1)[:, :most], np.take_along_axis(first, order, 1)[:, :most]))
    rows, keys = [], []
    for p, (i, j) in enumerate(combinations(range(3), 2)):
        both = near[i][1][:, :, None] & near[j][1][:, None, :]
        key = p << 24 | near[i][0][:, :, None] << 12 | near[j][0][:, None, :]
        rows.append(np.nonzero(both)[0])
        keys.append(key[both])
    return np.concatenate(rows), np.concatenate(keys)


def link_fingerprints(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints ``fp`` that hold the components of all pairs at ``max_bits`` or less.

    Three differing bits over three segments leave two segments with at most one
    each. Words at distance 1 share a decoded codeword once one of them is decoded
    with every single bit flipped (one to six codewords), so a fingerprint owns one
    key per pair of segments and looks for up to 36. Small buckets are joined and
    verified pair by pair; large ones are cut into blocks, whose links are reduced to
    a spanning forest in the task, so a group of g fingerprints never yields g^2 rows.
    """
    if max_bits > 3:
        raise ValueError("three segments cover up to 3 differing bits")

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            fp = part["fp"].to_numpy(np.int64)
            yield pd.DataFrame({"key": own_keys(fp).ravel(), "fp": np.repeat(fp, 3)})

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            whole = part["fp"].to_numpy(np.int64)
            for at in range(0, len(whole), 4096):
                fp = whole[at : at + 4096]
                rows, keys = near_keys(fp)
                yield pd.DataFrame({"key": keys, "fp": fp[rows]})

    def in_block(group: pd.DataFrame) -> pd.DataFrame:
        owners = group["fp"].to_numpy(np.int64)[group["owner"].to_numpy(bool)].view(np.uint64)
        seekers = group["fp"].to_numpy(np.int64)[~group["owner"].to_numpy(bool)].view(np.uint64)
        ends: list[np.ndarray] = [np.empty(0, np.int64)] * 2
        for at in range(0, len(seekers), 512):
            part = seekers[at : at + 512]
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ owners[None, :]) <= max_bits)
            u, v = part[i].view(np.int64), owners[j].view(np.int64)
            ends = list(spanning(np.concatenate([ends[0], u]), np.concatenate([ends[1], v])))
        return pd.DataFrame({"a": ends[0], "b": ends[1]})

    owned = stage(prints.select("fp").mapInPandas(own, "key long, fp long"), "owned")
    wanted = prints.select("fp").mapInPandas(near, "key long, fp long")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = owned.groupBy("key").agg(F.count("*").alias("owners")).where(F.col("owners") > SMALL_BUCKET)
    sizes = stage(sizes.select("key", blocks("owners").alias("parts")), "sizes")

    # Up to 108 wanted keys come from one fingerprint, of which the planner knows nothing: it must not broadcast them.
    small = owned.join(sizes, "key", "left_anti").withColumnRenamed("fp", "other")
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    links = wanted.hint("merge").join(small, "key").where((F.col("fp") < F.col("other")) & close)
    links = links.select(F.col("fp").alias("a"), F.col("other").alias("b"))

    # Seekers of a large bucket are dealt to blocks of their own; each meets every block of owners. A semi-join can only broadcast the buckets.
    seeking = stage(wanted.join(sizes, "key", "left_semi"), "seeking")
    seekers = seeking.groupBy("key").agg(F.count("*").alias("n")).select("key", blocks("n").alias("seeker_parts"))
    buckets = stage(sizes.join(seekers, "key"), "buckets")
    part = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    left = seeking.join(buckets, "key").select(
        "key",
        part("seeker_parts").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"),
        "fp",
        F.lit(False).alias("owner"),
    )
    right = owned.join(buckets, "key").select(
        "key",
        F.explode(F.sequence(F.lit(0), F.col("seeker_parts") - 1)).alias("i"),
        part("parts").alias("j"),
        "fp",
        F.lit(True).alias("owner"),
    )
    dense = left.unionAll(right).groupBy("key", "i", "j").applyInPandas(in_block, "a long, b long")
    return links.unionAll(dense)


def groups(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """``(fp, group_fp, component_id)`` for each distinct fingerprint of ``(doc_id, fp)``."""
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = components(link_fingerprints(nodes, max_bits)).select(F.col("id").alias("fp"), F.col("component_id").alias("root"))
    nodes = nodes.join(found, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("group_fp"))
    names = nodes.groupBy("group_fp").agg(F.min("first_id").alias("component_id"))
    return nodes.select("fp", "group_fp").join(names, "group_fp").select("fp", "group_fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``(doc_id, fp, group_fp, component_id)``, one row per row of ``docs``.

    Documents link when their fingerprints differ in ``max_bits`` bits or less.
    ``component_id`` is the smallest doc_id reachable (null ids are passed over; null
    if a component has no other), ``group_fp`` names the component. Null and blank
    texts have fingerprint zero, shorter texts than a shingle are one shingle, and
    repeated rows stay. Other columns of ``docs`` are not looked at. Equal
    fingerprints are one node, so exact copies cost one aggregation.
    """
    prints = stage(with_fingerprints(docs, shingle=shingle), "fingerprints")
    return prints.join(groups(prints, max_bits), "fp").select("doc_id", "fp", "group_fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``: that of the smallest doc_id.

    Of rows that repeat this id in the group one stays, and of a group without any id one row.
    Texts move once, and only those of rows whose id is kept.
    """
    prints = stage(with_fingerprints(docs, shingle=shingle), "fingerprints")
    found = stage(groups(prints, max_bits), "groups")
    kept = found.select(F.col("component_id").alias("kept_id")).distinct()
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
    marked = with_fingerprints(rows, tuple(docs.columns), shingle)
    names = found.select(F.col("fp").alias("_fp"), F.col("group_fp").alias("_group"), F.col("component_id").alias("_first"))
    marked = marked.toDF(*docs.columns, "_own_fp")
    one = marked.join(names, F.col("_own_fp") == F.col("_fp")).where(F.col("doc_id").eqNullSafe(F.col("_first")))
    return one.dropDuplicates(["_group"]).select(*docs.columns)
