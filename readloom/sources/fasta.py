"""FASTA to fixed-width chunks.

The file is read in splits like any text. Each split puts its lines together on its
own; what it owes to earlier splits, the contig that is open and the bases seen
of it, is one row per split.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.functions.texts import ROUNDS, blocks_of
from readloom.operators.staging import stage

_BLOCKS = "_file string, _split bigint, _order bigint, _open string, _at bigint, _size int, _text string"


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines ``_file, _split, _name, _text`` in order as blocks of ``ROUNDS[-1]`` bases: a header has a name, a stretch of bases none.

    ``_at`` counts bases from the header ``_open``, or from the start of the split where it has none so far. A header
    that ends its split gives an empty block.
    """
    width, names = ROUNDS[-1], [c.split()[0] for c in _BLOCKS.split(", ")]
    split, opened, at, held, size, order, rows = (None, None), None, 0, [], 0, 0, []

    def give(text: str) -> None:
        nonlocal at, order
        rows.append((*split, order, opened, at, len(text), text))
        at, order = at + len(text), order + 1

    def close() -> None:
        nonlocal held, size
        if held or (opened is not None and at == 0):
            give("".join(held))
        held, size = [], 0

    def batch() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for lines in batches:
        for file, start, name, text in zip(*(c.to_pylist() for c in lines.columns), strict=True):
            if (file, start) != split:
                close()
                split, opened, at, order = (file, start), None, 0, 0
            if name is not None:
                close()
                opened, at = name, 0
                continue
            held.append(text)
            size += len(text)
            if size >= width:
                whole = "".join(held)
                for i in range(0, size - width + 1, width):
                    give(whole[i : i + width])
                held = [whole[size - size % width :]] if size % width else []
                size %= width
        if rows:
            yield batch()
            rows.clear()
    close()
    if rows:
        yield batch()


def read_fasta(spark: SparkSession, path: str, width: int = 1024, overlap: int = 0) -> DataFrame:
    """``contig, chunk_start, bases``: chunks of ``width`` bases and ``overlap`` more, starts from 1."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.make_valid_utf8(F.rtrim("value")).alias("_text"),
    )
    header = F.startswith("_text", F.lit(">"))
    name = F.when(header, F.regexp_extract("_text", r"^>\s*(\S+)", 1))
    # A line of any length in blocks, so that no row is longer.
    parts = F.when(header, F.array(F.lit(""))).otherwise(blocks_of(F.col("_text")))
    lines = lines.select("_file", "_split", name.alias("_name"), F.explode(parts).alias("_text"))
    # Executors need not have this package: what the tasks run travels with the query.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    blocks = stage(lines.mapInArrow(_put_together, _BLOCKS), "fasta_blocks", "zstd")
    split = ["_file", "_split"]
    ends = blocks.groupBy(*split).agg(
        F.max_by("_open", "_order").alias("_open"),
        F.sum("_size").alias("_all"),
        # Bases of the split before its last header.
        (F.sum("_size") - F.max_by(F.when(F.col("_open").isNotNull(), F.col("_at") + F.col("_size")), F.col("_order"))).alias("_base"),
    )
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("_all").over(earlier), F.lit(0))
    carried = (
        ends.withColumn("_total", total)
        .withColumn("_carry_open", F.last("_open", ignorenulls=True).over(earlier))
        # Bases of the file before the contig that is open when the split starts.
        .withColumn("_carry_base", F.max(F.col("_total") + F.col("_base")).over(earlier))
        .select(*split, "_carry_open", (F.col("_total") - F.coalesce("_carry_base", F.lit(0))).alias("_before"))
    )
    # A row per split, so the blocks stay where they are.
    placed = (
        blocks.where("_size > 0")
        .join(F.broadcast(carried), split)
        .select(
            F.coalesce("_open", "_carry_open").alias("contig"),
            (F.col("_at") + F.when(F.col("_open").isNull(), F.col("_before")).otherwise(0)).alias("_at"),
            "_size",
            "_text",
        )
        .where(F.col("contig").isNotNull())
    )
    # A block goes to every chunk it reaches, cut to fit; a chunk is width + overlap bases at most.
    size = F.col("_size")
    first = F.greatest(F.floor((F.col("_at") - (width + overlap) + 1 + width - 1) / width), F.lit(0))
    last = F.floor((F.col("_at") + size - 1) / width)
    cut = placed.withColumn("_chunk", F.explode(F.sequence(first, last)))
    low = F.col("_chunk") * width
    skip = F.greatest(low - F.col("_at"), F.lit(0)).cast("int")
    take = (F.least(low + width + overlap, F.col("_at") + size) - F.greatest(low, "_at")).cast("int")
    pieces = cut.withColumn("_take", take).select(
        "contig", "_chunk", "_at", F.substr("_text", skip + 1, F.col("_take")).alias("_piece"), "_take"
    )
    # Most chunks lie in one block; only what blocks share is put together in a shuffle.
    whole = pieces.where(F.col("_take") == width + overlap).select("contig", "_chunk", F.col("_piece").alias("bases"))
    parts = F.array_sort(F.collect_list(F.struct("_at", "_piece")))
    shared = (
        pieces.where((F.col("_take") > 0) & (F.col("_take") < width + overlap))
        .groupBy("contig", "_chunk")
        .agg(parts.alias("_parts"))
        .select("contig", "_chunk", F.array_join(F.col("_parts._piece"), "").alias("bases"))
    )
    start = (F.col("_chunk") * width + 1).cast("int").alias("chunk_start")
    return whole.union(shared).select("contig", start, "bases")
