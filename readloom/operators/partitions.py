"""Spreading of small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes up to which an input is dealt out anew; a shuffle of this size costs nothing on a cluster.
SMALL_INPUT = 512 << 20


def spread(scan: DataFrame, limit: int = SMALL_INPUT) -> DataFrame:
    """A scan of at most ``limit`` bytes, dealt out to all cores; anything larger is left where it is.

    For steps that turn a row into many. The splits of one small file hold no rows
    where the file has fewer row groups than splits. The planner's estimate of the
    size decides, so no file is listed or opened here.
    """
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism) if size <= limit else scan
