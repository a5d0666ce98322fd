from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cueloom import runtime
from cueloom.errors import ScratchDirError


def fake(master, conf=None, checkpoint=None):
    made = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: made[-1] if made else checkpoint, setCheckpointDir=made.append
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf or default), sparkContext=context)


def test_scratch_comes_from_the_session():
    assert runtime.scratch_dir(fake("spark://x", conf="s3://shared/cp")) == "s3://shared/cp"
    assert runtime.scratch_dir(fake("spark://x", checkpoint="hdfs:///cp")) == "hdfs:///cp"
    assert runtime.scratch_dir(fake("local[2]"))
    with pytest.raises(ScratchDirError):
        runtime.scratch_dir(fake("spark://x"))


def test_broadcast_is_size_checked(spark):
    rows = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert runtime.fits_broadcast(rows, 200_000)
    assert not runtime.fits_broadcast(rows, 100_000)
    assert runtime.fits_broadcast(rows.limit(0), 0)


def test_only_narrow_scans_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    cores = spark.sparkContext.defaultParallelism
    assert runtime.spread(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == cores
    wide = spark.range(100).repartition(cores + 3)
    assert runtime.spread(wide) is wide
