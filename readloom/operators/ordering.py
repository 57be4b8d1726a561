"""Total orders over data that no single task could hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.staging import stage

# monotonically_increasing_id keeps the row number in the low 33 bits.
_ROW_BITS = 33


def layout(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range partitions sorted inside; end the order with a unique id so that one hot position splits."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def ranked(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """Row number from 1 along ``order``, per ``group``, without a task per group.

    Rows are range-partitioned and staged with their place in the partition; the
    number is that place plus the rows of the group in earlier partitions. The
    offsets hold one row per partition and group, at most partitions + groups.
    """
    keys = [*group, *order]
    placed = layout(df, keys).withColumn("_place", F.monotonically_increasing_id())
    fixed = stage(placed, "ranked").withColumn("_part", F.shiftright("_place", _ROW_BITS))
    sizes = fixed.groupBy(*group, "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_part").alias("_g_part"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    if not group:
        # A row per partition; all rows of a partition would meet in a task otherwise.
        offsets = F.broadcast(offsets)
    same = F.col("_part") == F.col("_g_part")
    for c in group:
        # A NULL group is a group.
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    rank = F.col("_before") + F.col("_place") - F.col("_first") + 1
    return (
        fixed.join(offsets, same)
        .withColumn(name, rank)
        .drop("_part", "_place", "_first", "_before", "_g_part", *[f"_g_{c}" for c in group])
    )
