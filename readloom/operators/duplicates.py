"""Duplicate reads."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.cigar import five_prime
from readloom.operators.staging import stage

_MATE = ["_mate_contig", "_mate_pos", "_mate_reverse"]


def _keyed(reads: DataFrame, contig: str, reverse: Column, mate: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    key = {"_contig": F.col(contig), "_reverse": reverse, "_five_prime": five_prime("pos", "cigar", reverse)}
    if mate:
        key |= {name: F.col(c) for name, c in zip(_MATE, mate, strict=True)}
    return reads.withColumns(key), list(key)


def mark_duplicates(
    reads: DataFrame,
    ids: Sequence[str],
    score: str = "mapq",
    reverse: Column | str = "neg",
    contig: str = "ref_idx",
    mate: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Flag ``is_dup`` on all but the best read of each contig, strand and unclipped 5' position.

    Best is the highest ``score`` (NULL is the lowest), then the smallest ``ids``; rows that agree in
    key, score and ids count as one read. ``mate`` names the mate's contig,
    position and strand columns and ``within`` further columns, such as a
    library, that keep reads apart.

    The best read is a minimum with partial aggregation, joined back on the
    ids: a position that holds a third of all reads never meets in a task. A whole-number
    score and a single whole-number id are packed into one decimal, which Spark
    aggregates by hash; other ids are compared as a struct, which it sorts.
    """
    reverse = F.col(reverse) if isinstance(reverse, str) else reverse
    keyed, key = _keyed(reads, contig, reverse, mate)
    same = [*key, *within]
    if len(ids) == 1 and _is(reads, score, "byte", "short", "integer") and _is(reads, ids[0], "integer", "long"):
        keyed = keyed.withColumn("_rank", _packed(F.col(score), F.col(ids[0])))
        best = keyed.groupBy(*same).agg(F.min("_rank").alias("_w_rank"))
        winners = best.select("_w_rank", *[F.col(c).alias(f"_w_{c}") for c in same], F.lit(True).alias("_kept"))
        return _flagged(keyed, winners, F.col("_rank") == F.col("_w_rank"), same, reads.columns)
    # The smallest number of its type has no opposite in it.
    wide = F.col(score).cast("decimal(20,0)") if _is(reads, score, "byte", "short", "integer", "long") else F.col(score)
    rank = F.struct(F.col(score).isNull().alias("_none"), (-wide).alias("_score"), *ids)
    best = keyed.groupBy(*same).agg(F.min(rank).alias("_best"))
    winners = best.select(
        *[F.col(f"_best.{c}").alias(f"_w_{c}") for c in ids],
        (-F.col("_best._score")).alias("_w_score"),
        *[F.col(c).alias(f"_w_{c}") for c in same],
        F.lit(True).alias("_kept"),
    )
    meets = F.col(score).eqNullSafe(F.col("_w_score"))
    for c in ids:
        meets = meets & (F.col(c) == F.col(f"_w_{c}"))
    return _flagged(keyed, winners, meets, same, reads.columns)


def _is(df: DataFrame, name: str, *types: str) -> bool:
    return df.schema[name].dataType.typeName() in types


def _packed(score: Column, number: Column) -> Column:
    """Falling score, NULL last, then rising number, as one decimal: score above 64 bits of number."""
    falling = F.coalesce(-score.cast("decimal(11,0)"), F.lit(Decimal(1 << 32)))
    return falling * F.lit(Decimal(1 << 64)) + (number.cast("decimal(20,0)") + F.lit(Decimal(1 << 63)))


def _number(rank: Column) -> Column:
    """The number in a rank of ``_packed``."""
    return (F.pmod(rank, F.lit(Decimal(1 << 64))) - F.lit(Decimal(1 << 63))).cast("bigint")


def _flagged(keyed: DataFrame, winners: DataFrame, meets: Column, same: Sequence[str], columns: Sequence[str]) -> DataFrame:
    for c in same:
        meets = meets & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    found = keyed.join(winners, meets, "left")
    return found.select(*[F.col(c) for c in columns], F.col("_kept").isNull().alias("is_dup"))


def duplicate_counts(
    reads: DataFrame,
    reverse: Column | str = "neg",
    contig: str = "ref_idx",
    mate: Sequence[str] | None = None,
    library: Sequence[str] = (),
) -> DataFrame:
    """Reads and duplicates per library, straight from the keys.

    One read per key is kept, so reads minus keys are the duplicates: neither
    the scores nor the flags of ``mark_duplicates`` are needed.
    """
    reverse = F.col(reverse) if isinstance(reverse, str) else reverse
    keyed, key = _keyed(reads, contig, reverse, mate)
    sizes = keyed.groupBy(*key, *library).agg(F.count("*").alias("_n"))
    return sizes.groupBy(*library).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dups")
    )


def dup_metrics(marked: DataFrame, library: Sequence[str] = ()) -> DataFrame:
    """Reads, duplicates and their share per library, from reads that carry ``is_dup``."""
    counted = marked.groupBy(*library).agg(
        F.count("*").alias("n"), F.count_if("is_dup").alias("dups")
    )
    return counted.withColumn("fraction", F.when(F.col("n") > 0, F.col("dups") / F.col("n")))


def _end(contig: str, reverse: Column) -> Column:
    """Contig, unclipped 5' position and strand of a read as one long; contigs up to 2 ** 27."""
    five = five_prime("pos", "cigar", reverse).cast("bigint") + (1 << 33)
    one = F.lit(1).cast("bigint")
    return (F.col(contig) + one) * (1 << 35) + five * 2 + F.when(reverse, one).otherwise(one - 1)


def mark_pair_duplicates(
    reads: DataFrame,
    read_id: str,
    template: Sequence[str],
    score: str = "score",
    reverse: Column | str = "neg",
    contig: str = "ref_idx",
    within: Sequence[str] = (),
) -> DataFrame:
    """Flag ``is_dup`` on the reads of all but the best of each group of equal fragments, and say of which in ``dup_of``.

    Two reads of one ``template`` are a pair, whose key is both unclipped 5' ends: a clip at either end
    splits no group. Of equal pairs the one with the highest sum of scores stays, then that with the smallest
    ``read_id``; both of its ends stay, and both ends of the others are flagged. All other reads (one of its
    template, or more than two, or of no template) are single: the best of an end stays, and all are flagged where a
    pair has the same end. ``within`` names columns, such as a library, that keep fragments apart. ``read_id`` is
    a whole number of its own for each read, ``score`` a whole number whose NULL is the lowest.

    ``dup_of`` is the ``read_id`` of the first read of the fragment that a duplicate equals; NULL for reads that stay,
    and for single reads that lose to a pair.

    Keys are longs and ranks decimals, so every aggregation is one by hash with partial sums; an end that holds a
    third of all reads never meets in a task. What the steps share is staged without sequences.
    """
    reverse = F.col(reverse) if isinstance(reverse, str) else reverse
    own = {f"_t{i}": F.col(c) for i, c in enumerate(template)} | {f"_w{i}": F.col(c) for i, c in enumerate(within)}
    apart = [f"_w{i}" for i in range(len(within))]
    named = [f"_t{i}" for i in range(len(template))]
    ends = reads.select(
        F.col(read_id).cast("bigint").alias("_id"), F.col(score).cast("int").alias("_score"), _end(contig, reverse).alias("_end"),
        *[column.alias(name) for name, column in own.items()],
    )
    ends = stage(ends, "ends")
    whole = F.lit(True)
    for c in named:
        whole = whole & F.col(c).isNotNull()
    pairs = ends.where(whole).groupBy(*named, *apart).agg(
        F.count("*").alias("_n"), F.min("_end").alias("_low"), F.max("_end").alias("_high"),
        F.sum(F.coalesce("_score", F.lit(-1))).cast("int").alias("_score"), F.min("_id").alias("_first"),
    )
    pairs = pairs.where(F.col("_n") == 2).withColumn("_rank", _packed(F.col("_score"), F.col("_first")))
    pairs = stage(pairs.select(*named, *apart, "_low", "_high", "_rank"), "pairs")
    best = pairs.groupBy("_low", "_high", *apart).agg(F.min("_rank").alias("_best"))
    judged = _joined(pairs, best, ["_low", "_high", *apart]).select(
        *named, *apart, (F.col("_rank") != F.col("_best")).alias("_pair_dup"), _number(F.col("_best")).alias("_pair_of")
    )
    found = stage(_joined(ends, judged, [*named, *apart], "left"), "judged")
    single = F.col("_pair_dup").isNull()
    rank = _packed(F.col("_score"), F.col("_id"))
    groups = found.groupBy("_end", *apart).agg(
        F.min(F.when(single, rank)).alias("_best"), F.count_if(~single).alias("_pairs")
    )
    lost = (F.col("_pairs") > 0) | (rank != F.col("_best"))
    equal = F.when(F.col("_pairs") == 0, _number(F.col("_best")))
    # Reads of pairs are judged already: only single ones ask what else has their end.
    lone = _joined(found.where(single), groups, ["_end", *apart]).select("_id", lost.alias("is_dup"), F.when(lost, equal).alias("dup_of"))
    paired = found.where(~single).select("_id", F.col("_pair_dup").alias("is_dup"), F.when(F.col("_pair_dup"), F.col("_pair_of")).alias("dup_of"))
    flags = lone.union(paired)
    return reads.join(flags, F.col(read_id) == F.col("_id")).drop("_id")


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on columns of the same names, in which NULL equals NULL."""
    named = right.select(*[F.col(c).alias(f"_r{c}") if c in on else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    return left.join(named, same, how).drop(*[f"_r{c}" for c in on])


# Pixels within which copies of one cluster lie.
OPTICAL_PIXELS = 100
# Copies of a read that meet it at once.
COPIES = 100_000
# Halvings of the range in which the size of a library is sought.
HALVINGS = 40


def flow_cell_place(name: Column) -> Column:
    """``struct<tile, x, y>`` of a read name whose last three fields, by colons, are tile, x and y; NULL for others.

    ``tile`` keeps all fields before, so equal tiles are tiles of one lane.
    """
    parts = F.regexp_extract_all(name, F.lit(r"^(.*:[0-9]+):([0-9]+):([0-9]+)(?:[ /].*)?$"), F.lit(1))
    x = F.regexp_extract(name, r"^.*:[0-9]+:([0-9]+):([0-9]+)(?:[ /].*)?$", 1).try_cast("int")
    y = F.regexp_extract(name, r"^.*:[0-9]+:([0-9]+):([0-9]+)(?:[ /].*)?$", 2).try_cast("int")
    return F.when(F.size(parts) > 0, F.struct(parts[0].alias("tile"), x.alias("x"), y.alias("y")))


def with_optical(marked: DataFrame, read_id: str, name: str = "qname", pixels: int = OPTICAL_PIXELS, copies: int = COPIES) -> DataFrame:
    """Duplicates of ``mark_pair_duplicates`` with ``is_optical``: on the tile of the read that stays, ``pixels`` or less away in x and in y.

    Each duplicate meets the one read it equals, so a group of g copies costs g rows. Reads whose name says no place are not
    optical. Only duplicates that name a read are joined, and a read with more than ``copies`` of them meets them in
    as many parts, so neither a large group nor the reads without ``dup_of`` come together in a task. The large groups
    are broadcast: a row for every ``copies`` reads at most.
    """
    place = flow_cell_place(F.col(name))
    named = marked.where(F.col("dup_of").isNotNull())
    sizes = named.groupBy("dup_of").agg(F.ceil(F.count("*") / copies).cast("int").alias("_parts"))
    large = sizes.where("_parts > 1").select(F.col("dup_of").alias("_large"), "_parts")
    part = F.coalesce(F.pmod(F.xxhash64(read_id), F.col("_parts")), F.lit(0)).cast("int")
    named = named.join(F.broadcast(large), F.col("dup_of") == F.col("_large"), "left").withColumn("_part", part)
    kept = marked.where(~F.col("is_dup")).join(F.broadcast(large), F.col(read_id) == F.col("_large"), "left").select(
        F.col(read_id).alias("_kept"), place.alias("_there"),
        F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_there_part"),
    )
    here = F.col("_here")
    there = F.col("_there")
    near = (here["tile"] == there["tile"]) & (F.abs(here["x"] - there["x"]) <= pixels) & (F.abs(here["y"] - there["y"]) <= pixels)
    met = named.withColumn("_here", place).join(kept, (F.col("dup_of") == F.col("_kept")) & (F.col("_part") == F.col("_there_part")), "left")
    found = met.select(*marked.columns, F.coalesce(F.col("is_dup") & near, F.lit(False)).alias("is_optical"))
    return found.union(marked.where(F.col("dup_of").isNull()).withColumn("is_optical", F.lit(False)))


def library_size(pairs: Column, distinct: Column) -> Column:
    """Fragments in a library of which ``pairs`` were read and ``distinct`` are different; NULL without duplicates.

    The x that solves distinct / x = 1 - exp(-pairs / x): reading draws with replacement. Found by halving a range, inside
    the expression.
    """
    n, c = pairs.cast("double"), distinct.cast("double")
    left = lambda times: 1 / times - 1 + F.exp(-n / (times * c))
    widened = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(100.0), lambda high, _: F.when(left(high) > 0, high * 10).otherwise(high))

    def halve(range_: Column, _: Column) -> Column:
        middle = (range_["low"] + range_["high"]) / 2
        above = left(middle) > 0
        return F.struct(
            F.when(above, middle).otherwise(range_["low"]).alias("low"), F.when(above, range_["high"]).otherwise(middle).alias("high")
        )

    start = F.struct(F.lit(1.0).alias("low"), widened.alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve, lambda r: c * (r["low"] + r["high"]) / 2)
    return F.when((distinct > 0) & (pairs > distinct), F.round(found).cast("bigint"))


def pair_metrics(marked: DataFrame, template: Sequence[str], library: Sequence[str] = ()) -> DataFrame:
    """Per library: ``pairs`` (templates of two reads), ``pair_dups``, ``pair_optical``, ``single``, ``single_dups`` and ``library_size``.

    ``marked`` as from ``with_optical``. A pair is optical if its first read is, by the smaller of its ends. The size of
    the library leaves optical copies out, as they say nothing of how often a fragment was drawn.
    """
    whole = F.lit(True)
    for c in template:
        whole = whole & F.col(c).isNotNull()
    lone = marked.withColumn("_no", F.monotonically_increasing_id()).withColumn("_lone", F.when(~whole, F.col("_no")))
    per = lone.groupBy(*template, *library, "_lone").agg(
        F.count("*").alias("_n"), F.count_if("is_dup").alias("_dups"), F.count_if("is_optical").alias("_opticals")
    )
    pair = F.col("_n") == 2
    counted = per.groupBy(*library).agg(
        F.count_if(pair).alias("pairs"), F.count_if(pair & (F.col("_dups") > 0)).alias("pair_dups"),
        F.count_if(pair & (F.col("_opticals") > 0)).alias("pair_optical"),
        F.coalesce(F.sum(F.when(~pair, F.col("_n"))), F.lit(0)).alias("single"),
        F.coalesce(F.sum(F.when(~pair, F.col("_dups"))), F.lit(0)).alias("single_dups"),
    )
    size = library_size(F.col("pairs") - F.col("pair_optical"), F.col("pairs") - F.col("pair_dups"))
    return counted.withColumn("library_size", size)
