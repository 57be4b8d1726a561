"""Genomic-shaped views of the driver tables, by integer arithmetic on whole tables.

They mirror the views in FIXTURES.md. ``IDS`` identifies a read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.operators import reads as R
from readloom.operators import recal
from readloom.operators.partitions import spread
from readloom.operators.staging import stage

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
READ_IDS = ["ok", "ln", "pk", "sk"]
READ_LENGTH = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread() -> str:
    return "l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads on contigs -1..25: unmapped, chrM-like and random-like ones included."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *IDS,
        "cast(l_partkey % 27 as int) - 1 as ref_idx",
        f"cast(1 + ({_spread()}) % 200000 as int) as pos",
        "case l_linenumber % 5 when 0 then '100M' when 1 then '10S90M' when 2 then '50M2D48M' "
        "when 3 then '40M3I57M' else '60M20N40M' end as cigar",
        "cast(l_quantity as int) as mapq",
        "l_returnflag = 'R' and l_linestatus = 'F' as neg",
        "cast(l_suppkey % 4 as int) as chunk",
    )


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_end(R.placed(reads(spark, sf_dir)))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reads on contigs of about 2,000 bases."""
    return reads(spark, sf_dir).withColumn("pos", F.expr("cast(1 + pos % 2000 as int)"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "case n_nationkey when 0 then 'M' when 23 then 'X' when 24 then 'y' else cast(n_nationkey as string) end"
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as ref_idx", f"concat('chr', {name}) as contig", "1900 + n_nationkey as length"
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "cast(p_partkey % 24 as int) + 1 as ref_idx",
        "cast((p_partkey * 7919) % 200000 as int) as start0",
        "cast((p_partkey * 7919) % 200000 + 150 + p_size * 10 as int) as end0",
    )


def with_quals(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = "case when ref_idx % 3 = 0 then case when l_linenumber % 2 = 0 then 60 else 40 end else 51 end"
    quals = f"transform(sequence(0, 9), i -> cast((l_orderkey + i * 7) % 10 + {base} as int))"
    return placed(spark, sf_dir).withColumn("quals", F.expr(quals))


def sequenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ungapped reads of 50 bases on contigs of about 3,000."""
    rows = spread(table(spark, sf_dir, "lineitem").select(*IDS))
    return rows.selectExpr(
        "l_orderkey as ok",
        "l_linenumber as ln",
        "l_partkey as pk",
        "l_suppkey as sk",
        "cast(1 + l_partkey % 24 as int) as ref_idx",
        f"cast(1 + ({_spread()}) % 3000 as int) as pos",
    )


def bases(spark: SparkSession, sf_dir: str, sites: DataFrame | None = None) -> DataFrame:
    """Bases of ``sequenced`` with quality, cycle and mismatch; without those on ``sites``."""
    rows = recal.base_rows(sequenced(spark, sf_dir), "pos", F.lit(READ_LENGTH), sites)
    return rows.selectExpr(
        *READ_IDS,
        "ref_idx",
        "p",
        "o",
        "cast((ok + ln + o) % 8 as int) as cyc",
        "cast(20 + (ok + o) % 20 as int) as q",
        "(ok * 31 + sk * 7 + o) % 97 = 0 or (p % 151 = 0 and (ok + pk) % 2 = 0) as mm",
    )


def _letter(p: str) -> str:
    return f"({p} * {p} + {p} div 3 + ref_idx)"


def base_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sequenced`` with the cycles and qualities of ``bases`` as arrays along the read."""
    return sequenced(spark, sf_dir).selectExpr(
        *READ_IDS,
        f"transform(sequence(0, {READ_LENGTH - 1}), o -> cast((ok + ln + o) % 8 as int)) as cycles",
        f"transform(sequence(0, {READ_LENGTH - 1}), o -> cast(20 + (ok + o) % 20 as int)) as quals",
    )


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs of 3,049 bases in chunks of 700 that overlap by 100."""
    base = f"substring('ACGT', cast({_letter('p')} % 4 as int) + 1, 1)"
    return (
        contigs(spark, sf_dir)
        .selectExpr("ref_idx", "explode(sequence(1, 3049, 700)) as chunk_start")
        .selectExpr(
            "ref_idx",
            "chunk_start",
            f"array_join(transform(sequence(chunk_start, least(chunk_start + 799, 3049)), p -> {base}), '') as bases",
        )
    )


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sequenced`` with bases and qualities, written as an aligner would; about half the reads differ at every 151st position, 1 % elsewhere."""
    rows = sequenced(spark, sf_dir)
    unknown = F.exists(F.array(*[F.col(c).isNull() for c in ("ok", "ln", "pk", "sk")]), lambda x: x)
    rest = ["ref_idx", "pos", f"'{READ_LENGTH}M' as cigar", "sk % 2 = 0 as neg", "ln % 2 = 0 as second"]
    differs = "(ok * 31 + sk * 7 + o) % 97 = 0 or ((pos + o) % 151 = 0 and (ok + pk) % 2 = 0)"
    number = f"{_letter('(pos + o)')} + case when {differs} then 1 + (ok + o) % 3 else 0 end"
    along = f"sequence(0, {READ_LENGTH - 1})"
    shown = f"substring('ACGT', cast(({number}) % 4 as int) + 1, 1)"
    # Keys that are not known say what of a read is; all others go by the batch.
    odd = rows.where(unknown).selectExpr(
        *READ_IDS, *rest,
        f"array_join(transform({along}, o -> {shown}), '') as seq",
        f"transform({along}, o -> cast(20 + (ok + o) % 20 as int)) as quals",
    )
    length = READ_LENGTH

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``substring`` counts from 1, and what is below from the end; 0 is 1.
        bases = np.frombuffer(b"GTAACGT", np.uint8)
        for batch in batches:
            n = batch.num_rows
            ok, pk, sk, ref, pos = (batch.column(c).to_numpy().astype(np.int64)[:, None] for c in ("ok", "pk", "sk", "ref_idx", "pos"))
            o = np.arange(length, dtype=np.int64)[None, :]
            p = pos + o
            differs = (ok * 31 + sk * 7 + o) % 97 == 0
            differs |= (p % 151 == 0) & ((ok + pk) % 2 == 0)
            number = p * p + (p - np.fmod(p, 3)) // 3 + ref + np.where(differs, 1 + np.fmod(ok + o, 3), 0)
            seq = pa.StringArray.from_buffers(
                n, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * length), pa.py_buffer(bases[np.fmod(number, 4) + 3])
            )
            quals = pa.array((20 + np.fmod(ok + o, 20)).astype(np.int32).ravel())
            quals = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * length), quals)
            yield pa.RecordBatch.from_arrays([*batch.columns, seq, quals], names=[*batch.schema.names, "seq", "quals"])

    named = rows.where(~unknown).select(*READ_IDS, "ref_idx", "pos")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema)
    made = named.mapInArrow(written, schema + ", seq string, quals array<int>").selectExpr(*READ_IDS, *rest, "seq", "quals")
    return stage(made.unionAll(odd), "letters")


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(1 + l_partkey % 24 as int) as ref_idx", "cast(151 * (l_partkey % 20) as int) as p"
    )
    return sites.distinct()


def call_set(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Variant keys; the line status says whether a row belongs to the truth (O) or the calls (F)."""
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
    return rows.selectExpr(
        "l_partkey % 26 as c",
        "l_orderkey % 500 as p",
        "substring('ACGT', cast(l_linenumber % 4 as int) + 1, 1) as r",
        "substring('CGTA', cast(l_suppkey % 4 as int) + 1, 1) as v",
    )


# A reference from the parts, and read pairs on it from the line items -----------

PART_WIDTH = 128
PAIR_LENGTH = 64
TEMPLATE = ["ok", "ln", "pk", "sk"]
_HEX, _ACGT = "0123456789abcdef", "ACGT" * 4


def _part_hex(part: str) -> str:
    """128 digits of a part, of which ``_part_text`` makes bases; every tenth part of a contig repeats the one five places before."""
    key = f"cast(case when ({part}) div 24 % 10 = 5 then ({part}) - 120 else {part} end as string)"
    return f"concat(sha2({key}, 256), sha2(concat({key}, 'x'), 256))"


def _part_text(part: str) -> str:
    return _bases(_part_hex(part))


def part_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs 0..23 as one chunk of 128 bases per part, that overlaps the next by 24."""
    text = f"concat({_part_text('p_partkey')}, left({_part_text('p_partkey + 24')}, 24))"
    last = table(spark, sf_dir, "part").agg(F.max("p_partkey")).scalar()
    rows = table(spark, sf_dir, "part").withColumn("_last", last)
    return rows.selectExpr(
        "concat('part', p_partkey % 24) as contig",
        f"cast(p_partkey div 24 * {PART_WIDTH} + 1 as int) as chunk_start",
        f"case when p_partkey + 24 > _last then {_part_text('p_partkey')} else {text} end as bases",
    )


def part_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").groupBy(F.expr("cast(p_partkey % 24 as int)").alias("ref_idx"))
    length = F.expr(f"cast((max(p_partkey div 24) + 1) * {PART_WIDTH} as int)")
    return rows.agg(length.alias("length")).withColumn("contig", F.concat(F.lit("part"), "ref_idx"))


def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of a fragment of about 300 bases per line item, 64 bases each, from the place of its part.

    One in 50 second ends differs at every 13th base, one in 40 first ends is noise, one in 30 fragments has an end only.
    """
    rows = spread(table(spark, sf_dir, "lineitem").select(*IDS)).selectExpr(
        "l_orderkey as ok", "l_linenumber as ln", "l_partkey as pk", "l_suppkey as sk"
    )
    # Cut out as digits: only the ends become bases.
    parts = ", ".join(_part_hex(f"pk + {24 * i}") for i in range(4))
    fragments = rows.selectExpr(
        "*", f"substring(concat({parts}), cast((ok * 7 + ln * 13) % 64 as int) + 1, cast(270 + (ok + sk * 3) % 60 as int)) as fragment"
    )
    first = f"translate(left(fragment, {PAIR_LENGTH}), '{_HEX}', '{_ACGT}')"
    noise = f"left(translate(sha2(concat('n', cast(ok as string)), 256), '{_HEX}', '{_ACGT}'), {PAIR_LENGTH})"
    second = f"reverse(translate(right(fragment, {PAIR_LENGTH}), '{_HEX}', '{'TGCA' * 4}'))"
    worn = ", ".join(f"substring(_second, {13 * i + 1}, 12), translate(substring(_second, {13 * i + 13}, 1), 'ACGT', 'CGTA')" for i in range(5))
    ends = (
        fragments.withColumn("_second", F.expr(second))
        .withColumn("_first", F.expr(f"case when (ok + pk) % 40 = 0 then {noise} else {first} end"))
        .withColumn("_second", F.expr(f"case when (ok + ln) % 50 = 0 then concat({worn}) else _second end"))
    )
    swapped = "case when sk % 2 = 0 then _second else _first end"
    other = "case when sk % 2 = 0 then _first else _second end"
    both = ends.selectExpr(
        *TEMPLATE, f"inline(filter(array(struct(1 as mate, {swapped} as seq), struct(2 as mate, {other} as seq)), "
        "e -> e.mate = 1 or (ok + 7 * pk) % 30 > 0))",
    )
    return stage(both.withColumn("qual", F.repeat(F.lit("I"), F.length("seq"))), "read_pairs", "zstd")


def _repeat_hex(part: str) -> str:
    """Digits of ``_repeat_text``."""
    first = f"({part} - 24 * (({part}) div 24 % 3 - 1))"
    unit = f"left({_part_hex(first)}, cast(1 + {first} % 4 as int))"
    return f"case when ({part}) div 24 % 3 = 0 then {_part_hex(part)} else left(repeat({unit}, {PART_WIDTH}), {PART_WIDTH}) end"


def _repeat_text(part: str) -> str:
    """128 bases of a part: of three parts of a contig one as ``_part_text``, the next two a unit of 1 to 4 bases over and over."""
    return _bases(_repeat_hex(part))


def _bases(digits: str) -> str:
    """Bases for digits, letters in capitals as they are."""
    return f"translate({digits}, '{_HEX}', '{_ACGT}')"


def repeat_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs 0..23 as one chunk of 128 bases per part, most of them short repeats."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey % 24 as int) as ref_idx",
        f"cast(p_partkey div 24 * {PART_WIDTH} + 1 as int) as chunk_start",
        f"{_repeat_text('p_partkey')} as bases",
    )


def gapped_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read of about 64 bases per line item on the repeats, with the gaps that its line number says."""
    rows = spread(table(spark, sf_dir, "lineitem").select(*IDS)).selectExpr(
        "*", f"concat({_repeat_hex('l_partkey')}, {_repeat_hex('l_partkey + 24')}) as _t",
        "cast((l_orderkey * 7 + l_linenumber * 13) % 8 * 16 + 1 as int) as _o",
    )
    read = """case l_linenumber % 5 when 1 then concat(substring(_t, _o, 40), substring(_t, _o + 42, 24))
      when 2 then concat(substring(_t, _o, 40), substring(_t, _o + 37, 3), substring(_t, _o + 40, 21))
      when 3 then concat(substring(_t, _o, 20), substring(_t, _o + 25, 10), 'A', substring(_t, _o + 35, 33))
      when 4 then concat('ACGTA', substring(_t, _o, 59)) else substring(_t, _o, 64) end"""
    gapped = rows.selectExpr(
        *IDS,
        "cast(l_partkey % 24 as int) as ref_idx",
        f"cast(l_partkey div 24 * {PART_WIDTH} + _o as int) as pos",
        "case l_linenumber % 5 when 1 then '40M2D24M' when 2 then '40M3I21M' when 3 then '20M5D10M1I33M' when 4 then '5S59M' else '64M' end as cigar",
        f"{_bases(read)} as seq",
    )
    return stage(gapped, "gapped_reads")


def spelled_calls(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Records of one or two alternate alleles on the repeats, in whatever spelling a caller may have used.

    A deletion of two bases (alone, with bases that both alleles share, or beside a substitution) and an insertion, all inside
    a part; the line status says which set a row belongs to.
    """
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status).select(*IDS)
    rows = spread(rows).selectExpr(
        "*", f"{_repeat_hex('l_partkey')} as _h", "cast(2 + (l_orderkey % 12) * 10 + l_suppkey % 2 * 2 as int) as _o",
        "l_linenumber % 4 as kind",
    ).withColumn("_t", F.expr(_bases("substring(_h, _o, 5)")))
    return rows.selectExpr(
        "concat('chr', l_partkey % 24) as contig",
        f"cast(l_partkey div 24 * {PART_WIDTH} + _o as int) as pos",
        "case kind when 3 then substring(_t, 1, 1) when 1 then substring(_t, 1, 5) else substring(_t, 1, 3) end as ref",
        """case kind when 0 then substring(_t, 1, 1) when 1 then concat(substring(_t, 1, 1), substring(_t, 4, 2))
          when 2 then concat(substring(_t, 1, 1), ',', translate(substring(_t, 1, 1), 'ACGT', 'CGTA'), lower(substring(_t, 2, 2)))
          else concat(substring(_t, 1, 1), substring(_t, 2, 2)) end as alt""",
    )


def fragment_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that start at few places, two lines of an order to a fragment, with names that say a place on a flow cell."""
    return reads(spark, sf_dir).selectExpr(
        *IDS,
        "cast(1 + l_orderkey % 3 as int) as ref_idx",
        "cast(1 + l_partkey % 6 * 40 as int) as pos",
        "cigar",
        "mapq",
        "neg",
        "(l_linenumber - 1) div 2 as fragment",
        "concat('lib', l_orderkey % 2) as lib",
        "concat_ws(':', 'm', l_orderkey % 4, (l_orderkey * 37 + (l_linenumber - 1) div 2 * 5) % 300, l_orderkey * 11 % 300) as qname",
    )
