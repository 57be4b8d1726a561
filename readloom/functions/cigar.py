"""CIGAR strings: spans, clips, aligned blocks and indel sites.

Walks over the operations stay in the JVM. Blocks and indels come from running
totals that grow no array step by step; ``trim_to`` still grows its string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from readloom.functions.arrays import indices, let, running_starts


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda acc, x: acc + x.cast("int"))


def _operations(cigar: Column) -> Column:
    """ARRAY<STRUCT<n INT, op STRING>>"""
    tokens = F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1))
    return F.transform(
        tokens,
        lambda t: F.struct(
            F.substr(t, F.lit(1), F.length(t) - 1).cast("int").alias("n"),
            F.right(t, F.lit(1)).alias("op"),
        ),
    )


def _on_reference(op: Column) -> Column:
    return op.isin("M", "D", "N", "=", "X")


def _on_read(op: Column) -> Column:
    return op.isin("M", "I", "S", "=", "X")


def reference_length(cigar) -> Column:
    """Reference bases spanned: the lengths of M, D, N, = and X."""
    return _total(F.regexp_extract_all(_col(cigar), F.lit("([0-9]+)[MDN=X]"), F.lit(1)))


def alignment_end(pos, cigar) -> Column:
    """Last reference position covered, counted like ``pos``."""
    return _col(pos) + reference_length(cigar) - 1


def _clip(cigar: Column, pattern: str) -> Column:
    clips = F.regexp_extract(cigar, pattern, 0)
    total = _total(F.regexp_extract_all(clips, F.lit("([0-9]+)"), F.lit(1)))
    return F.when(F.contains(cigar, F.lit("S")) | F.contains(cigar, F.lit("H")), total).otherwise(0)


def five_prime(pos, cigar, reverse) -> Column:
    """Unclipped 5' position: soft and hard clips are added back on the 5' side."""
    cigar = _col(cigar)
    start = _col(pos) - _clip(cigar, "^([0-9]+[SH])+")
    end = alignment_end(pos, cigar) + _clip(cigar, "([0-9]+[SH])+$")
    return F.when(_col(reverse), end).otherwise(start)


def _starts(operations: Column, counts) -> Column:
    """Bases before each operation, of those operations that ``counts``."""
    return running_starts(F.transform(operations, lambda x: F.when(counts(x["op"]), x["n"]).otherwise(0)))


def _sites(operations: Column, wanted, site) -> Column:
    """``site`` of the index of each operation that is ``wanted``."""
    chosen = F.filter(indices(F.size(operations)), lambda i: wanted(operations[i]["op"]))
    return F.when(operations.isNotNull(), F.transform(chosen, site))


def aligned_blocks(pos, cigar) -> Column:
    """Gap-free aligned stretches: ARRAY<STRUCT<ref_start, read_start, n>>, read_start from 0."""
    start = _col(pos).cast("int")

    def walk(ops: Column, ref: Column, read: Column) -> Column:
        return _sites(
            ops,
            lambda op: _on_reference(op) & _on_read(op),
            lambda i: F.struct(
                (start + ref[i]).alias("ref_start"), read[i].alias("read_start"), ops[i]["n"].alias("n")
            ),
        )

    return let(
        _operations(_col(cigar)),
        lambda ops: let(
            _starts(ops, _on_reference), lambda ref: let(_starts(ops, _on_read), lambda read: walk(ops, ref, read))
        ),
    )


def gaps(pos, cigar) -> Column:
    """Insertions and deletions: ARRAY<STRUCT<locus INT, read_start INT, n INT, op STRING>>.

    ``locus`` is the first reference position at or after the operation, ``read_start`` the
    read bases before it.
    """
    start = _col(pos).cast("int")

    def walk(ops: Column, ref: Column, read: Column) -> Column:
        return _sites(
            ops,
            lambda op: op.isin("I", "D"),
            lambda i: F.struct(
                (start + ref[i]).alias("locus"), read[i].alias("read_start"), ops[i]["n"].alias("n"), ops[i]["op"].alias("op")
            ),
        )

    return let(
        _operations(_col(cigar)),
        lambda ops: let(
            _starts(ops, _on_reference), lambda ref: let(_starts(ops, _on_read), lambda read: walk(ops, ref, read))
        ),
    )


def indels(pos, cigar) -> Column:
    """Insertion and deletion sites: ARRAY<STRUCT<locus INT, op STRING>>.

    ``locus`` is the first reference position at or after the operation.
    """
    start = _col(pos).cast("int")

    def walk(ops: Column, ref: Column) -> Column:
        return _sites(
            ops,
            lambda op: op.isin("I", "D"),
            lambda i: F.struct((start + ref[i]).alias("locus"), ops[i]["op"].alias("op")),
        )

    return let(_operations(_col(cigar)), lambda ops: let(_starts(ops, _on_reference), lambda ref: walk(ops, ref)))


def trim_to(cigar, room) -> Column:
    """CIGAR that spans at most ``room`` reference bases; the read bases after it are soft-clipped."""

    def step(acc, x):
        on_ref, on_read = _on_reference(x.op), _on_read(x.op)
        fits = F.least(x.n, acc.room)
        # Gaps are kept only when aligned bases can still follow them.
        keep = (
            F.when(x.op == "H", x.n)
            .when(acc.room <= 0, F.lit(0))
            .when(on_ref & on_read, fits)
            .when(on_ref, F.when(x.n < acc.room, x.n).otherwise(0))
            .otherwise(x.n)
        )
        lost = F.when(on_read, x.n - keep).otherwise(0)
        kept = F.when(keep > 0, F.concat(keep.cast("string"), x.op)).otherwise(F.lit(""))
        tail_h = x.op == "H"
        return F.struct(
            F.when(on_ref, acc.room - x.n).otherwise(acc.room).alias("room"),
            (acc.clip + lost).alias("clip"),
            F.when(tail_h & (acc.body != ""), acc.body).otherwise(F.concat(acc.body, kept)).alias("body"),
            F.when(tail_h & (acc.body != ""), kept).otherwise(acc.tail).alias("tail"),
        )

    start = F.struct(
        _col(room).cast("int").alias("room"),
        F.lit(0).alias("clip"),
        F.lit("").alias("body"),
        F.lit("").alias("tail"),
    )

    def finish(acc):
        clip = F.when(acc.clip > 0, F.concat(acc.clip.cast("string"), F.lit("S"))).otherwise(F.lit(""))
        return F.concat(acc.body, clip, acc.tail)

    return F.aggregate(_operations(_col(cigar)), start, step, finish)
