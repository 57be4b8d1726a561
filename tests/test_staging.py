from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from readloom.operators.partitions import spread
from readloom.operators.staging import stage, staging_dir


def test_tables_go_to_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging_dir(spark) == folder
    df = spark.range(5).select("id", F.array(F.col("id").cast("int")).alias("a"))
    staged = stage(df, "numbers")
    assert rows(staged) == rows(df) and staged.dtypes == df.dtypes
    assert all(folder in f for f in staged.inputFiles())


def session(master, conf=None, context=None):
    folder = {"dir": context}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf),
        sparkContext=SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: folder["dir"],
            setCheckpointDir=lambda d: folder.update(dir=d),
        ),
    )


def test_own_folder_only_in_local_mode_and_only_where_none_is_set():
    assert staging_dir(session("yarn", conf="s3a://shared/x/")) == "s3a://shared/x"
    assert staging_dir(session("yarn", context="hdfs:///y")) == "hdfs:///y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_dir(session("yarn"))
    local = session("local[2]")
    assert staging_dir(local) == staging_dir(local)


def test_spread_only_small_scans(spark):
    cores = spark.sparkContext.defaultParallelism
    small = spark.range(0, 10, 1, 1)
    assert spread(small).rdd.getNumPartitions() == cores and rows(spread(small)) == rows(small)
    assert spread(small, limit=10) is small


def test_staged_tables_go_when_their_block_ends(spark, tmp_path):
    import os

    from readloom.operators.staging import stage, staged_tables

    with staged_tables(spark) as outer:
        first = stage(spark.range(5), "first")
        with staged_tables(spark) as inner:
            stage(spark.range(7), "second").write.parquet(str(tmp_path / "kept"))
        assert len(inner) == 1 and not os.path.exists(inner[0].removeprefix("file:"))
        assert first.count() == 5
    assert len(outer) == 1 and not os.path.exists(outer[0].removeprefix("file:"))
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 7
    with pytest.raises(ZeroDivisionError), staged_tables(spark) as broken:
        stage(spark.range(3), "third")
        1 / 0
    assert not os.path.exists(broken[0].removeprefix("file:"))
    assert stage(spark.range(2), "fourth").count() == 2
