"""Best-fit packing of documents into fixed windows, under conflicts of source and of duplicate cluster."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.arrays import let
from readloom.llm.common import WORD
from readloom.operators.staging import stage

#: Words of a bin.
CAPACITY = 2048
#: Documents of one source that a bin may hold.
PER_SOURCE = 2
#: Documents that one task packs.
SHARD = 4096


class Bins:
    """Open bins in order of residual, each with bitmaps of its sources and duplicate clusters."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def new(self) -> int:
        self.clusters.append(0)
        self.sources.append([0] * self.per_source)
        return len(self.clusters) - 1

    def clashes(self, at: int, source: int, cluster: int) -> bool:
        """Bit 0 stands for no source or no cluster; the last source bitmap holds the sources that are full."""
        return bool(self.clusters[at] & cluster or self.sources[at][-1] & source)

    def place(self, size: int, source: int, cluster: int, after: tuple[int, int]) -> tuple[int, int, tuple[int, int]]:
        """Bin, offset in it, and where the search ended: the tightest compatible bin, else a new one."""
        k = bisect_left(self.open, max((size, -1), after))
        while k < len(self.open) and self.clashes(self.open[k][1], source, cluster):
            k += 1
        if k < len(self.open):
            found = self.open.pop(k)
        else:
            found = (self.capacity, self.new())
        residual, at = found
        self.clusters[at] |= cluster
        for i, seen in enumerate(self.sources[at]):
            if not seen & source:
                self.sources[at][i] |= source
                break
        if residual > size:
            insort(self.open, (residual - size, at))
        return at, self.capacity - residual, found


def _order(doc: object) -> tuple:
    """Ids in order, null last; of an id with a number, the id decides."""
    found = doc[0] if isinstance(doc, tuple) else doc
    return found is None, found or 0


def pack_shard(docs: list[tuple], capacity: int, per_source: int) -> list[tuple]:
    """``(doc_id, piece, first_word, n_words, bin, offset)`` for ``(doc_id, n_words, source, cluster)``.

    Best fit, longest remainders first; full windows of long documents take bins of their own.
    """
    bins = Bins(capacity, per_source)
    rows: list[tuple] = []
    rest: list[tuple] = []
    copies = Counter(cluster for *_, cluster in docs)
    source_bit: dict = {}
    cluster_bit: dict = {}
    for doc, n, source, cluster in sorted(docs, key=lambda d: (_order(d[0]), d[3], d[1], str(d[2]))):
        full = n // capacity
        for piece in range(full):
            rows.append((doc, piece, piece * capacity, capacity, bins.new(), 0))
        if n % capacity:
            s = 0 if source is None else 1 << source_bit.setdefault(source, len(source_bit))
            c = 0 if copies[cluster] < 2 else 1 << cluster_bit.setdefault(cluster, len(cluster_bit))
            rest.append((-(n % capacity), cluster, str(source), len(rest), doc, full, s, c))
    rest.sort()
    last, after = None, (0, -1)
    for minus, cluster, source, _, doc, piece, s, c in rest:
        # The next copy of the same text and source fits nowhere before the bin that took the last one.
        after = after if c and last == (minus, cluster, source) else (0, -1)
        last = (minus, cluster, source)
        at, offset, after = bins.place(-minus, s, c, after)
        rows.append((doc, piece, piece * capacity, -minus, at, offset))
    return rows


PLACED = {"doc_id": pa.int64(), **dict.fromkeys(("piece", "first_word", "n_words", "bin", "offset", "shard"), pa.int32())}


def word_list(text: Column) -> Column:
    """Words of a text, split at ASCII white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, n_words, source, cluster`` of every row, with the columns named in ``more``, without the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_count(text, F.lit(WORD)).alias("n_words"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(
            F.translate(F.array_join(word_list(text), " "), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        ).alias("cluster"),
        *more,
    )


def placed(rows: DataFrame, parts: int, capacity: int, per_source: int) -> DataFrame:
    """The pieces of ``rows``, as from ``measured`` and with a column ``own`` that tells equal rows apart, in ``parts`` shards."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "source", "cluster", "own"), F.lit(parts)).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("own")
        owns = group.column("own").to_pylist()
        # A row stands for itself by its place in the group; its id and its number follow.
        docs = list(zip(*[group.column(c).to_pylist() for c in ("doc_id", "n_words", "source", "cluster")], strict=True))
        shard = group.column("shard")[0].as_py()
        found = [((doc, at), n, source, cluster) for at, (doc, n, source, cluster) in enumerate(docs)]
        rows = [(doc, *r, shard, owns[at]) for (doc, at), *r in pack_shard(found, capacity, per_source)]
        types = [*PLACED.values(), pa.int64()]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[*PLACED, "own"])

    columns = "doc_id long, piece int, first_word int, n_words int, bin int, offset int, shard int, own long"
    packed = dealt.where("n_words > 0").groupBy("shard").applyInArrow(run, columns)
    blank = dealt.where("n_words = 0").selectExpr(
        "doc_id", "0 as piece", "0 as first_word", "0 as n_words", "cast(null as int) as shard", "cast(null as int) as bin",
        "cast(null as int) as offset", "cast(own as long) as own",
    )
    return packed.select(blank.columns).unionAll(blank)


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """``(doc_id, piece, first_word, n_words, shard, bin, offset)``: where each piece of each document lies.

    A bin ``(shard, bin)`` holds ``capacity`` words. Documents are cut into full
    windows, which fill bins alone, and a remainder. Remainders go, longest first, to
    the bin with the least room left that takes them; a bin takes none of a
    duplicate cluster that it holds already (equal words, A-Z lowered) and at most
    ``per_source`` of a source. Null sources never clash. Documents are dealt to
    ``count / shard`` tasks by a hash of their row and of its number among equal rows, which also spreads
    hot sources, large groups of copies and rows that repeat whole; each task keeps at most about ``shard`` rows
    without texts. Every word lies in exactly one piece. Documents without words, null texts
    included, have one row with no bin. Repeated rows are packed each by itself. Other columns are not looked at.
    """
    equal = measured(docs).groupBy("doc_id", "n_words", "source", "cluster").agg(F.count("*").alias("copies"))
    rows = equal.withColumn("own", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
    parts = max(1, -(-docs.count() // shard))
    return placed(rows, parts, capacity, per_source).drop("own")


def pack_texts(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """The pieces of ``pack`` with their ``text``, words joined by single blanks; empty for documents without words.

    Rows are numbered in a written table, so the pieces of a row find its text again whatever else it
    repeats; a document's words are split once for all its pieces.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    numbered = stage(own.withColumn("own", F.monotonically_increasing_id()), "numbered")
    parts = max(1, -(-numbered.count() // shard))
    where = placed(measured(numbered, "own"), parts, capacity, per_source)
    names = ["piece", "first_word", "n_words", "shard", "bin", "offset"]
    pieces = where.groupBy("own").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("pieces"))
    cut = lambda words: F.transform(
        "pieces",
        lambda p: F.struct(
            *[p[n].alias(n) for n in names],
            F.when(p["n_words"] > 0, F.array_join(F.slice(words, p["first_word"] + 1, p["n_words"]), " ")).otherwise(F.lit("")).alias("text"),
        ),
    )
    met = numbered.select("own", "doc_id", "text").join(pieces, "own")
    return met.select("doc_id", F.inline(let(word_list(F.col("text")), cut)))


def windows(pieces: DataFrame) -> DataFrame:
    """``(shard, bin, n_words, doc_ids, text)``: the bins of ``pack_texts`` as texts, pieces in order of offset on lines of their own."""
    inside = pieces.where("bin is not null").groupBy("shard", "bin").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "text", "n_words"))).alias("inside")
    )
    return inside.select(
        "shard", "bin", F.aggregate("inside", F.lit(0), lambda n, p: n + p["n_words"]).alias("n_words"),
        F.col("inside.doc_id").alias("doc_ids"), F.array_join(F.col("inside.text"), "\n").alias("text"),
    )
