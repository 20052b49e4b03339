import os

from driftlog.session import _local_cores, scratch_path


def test_local_cores_from_master():
    assert _local_cores("local[8]") == 8
    assert _local_cores("local[4,2]") == 4
    assert _local_cores("local") == 1
    assert _local_cores("local[*]") == (os.cpu_count() or 1)


def test_scratch_under_the_configured_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "q1") == f"{root.rstrip('/')}/q1"
