import os

import pytest

from quaero import session


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_materialize_cuts_the_lineage(spark):
    df = session.materialize(spark.range(10).repartition(3), "numbers")
    assert df.count() == 10 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def _shuffle_blocks(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_materialize_leaves_no_shuffle_files(spark):
    before, kept = _shuffle_blocks(spark), spark.conf.get(session.SHUFFLE_CLEANUP)
    df = session.materialize(spark.range(1000).repartition(5, "id"), "numbers")
    assert _shuffle_blocks(spark) <= before and spark.conf.get(session.SHUFFLE_CLEANUP) == kept
    assert df.count() == 1000


def test_discard_deletes_a_table_and_nothing_else(spark, tmp_path):
    gone, stays = (session.materialize(spark.range(10), "numbers") for _ in range(2))
    files = gone.inputFiles()
    session.discard(gone)
    assert not any(os.path.exists(x.removeprefix("file://")) for x in files) and stays.count() == 10
    spark.range(3).write.parquet(str(tmp_path / "own"))
    own = spark.read.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError):
        session.discard(own)
    assert own.count() == 3
