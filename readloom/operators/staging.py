"""Written tables that cut lineage, in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_open: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables staged inside once the block ends, also by an error: write results in it, and read them after.

    Gives the list of their paths. Blocks may be nested; each removes its own. Without a block staged
    tables stay, as lazy results still read them.
    """
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield paths
    finally:
        _open.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def staging_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only where none is set.

    Executors on other machines do not see a temporary folder of this one, so a
    cluster has to name a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        # local-cluster has executors of its own, so it counts as a cluster.
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="readloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _open.get()) is not None:
        paths.append(path)
    return path


def stage(df: DataFrame, name: str = "table", compression: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Later stages then restart from files instead of recomputing when an executor
    is lost, read only the columns they need, and the planner knows the size. ``compression`` other than
    the session's pays for texts of few letters, as bases are. ``group_rows`` bounds the rows of a row group, which
    writers and readers hold whole, for rows of many MB: Parquet looks at the size of a group only once it has 100 rows.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    options = {"compression": compression, "parquet.block.row.count.limit": group_rows and str(group_rows)}
    df.write.options(**{k: v for k, v in options.items() if v}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
