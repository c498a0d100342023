"""Session helpers: scale sizing and shared folders."""

from __future__ import annotations

from shoreline.session import scale_conf, shared_dir


def test_scale_conf_sizes_partitions_from_input():
    tb100 = 100 * (1 << 40)
    conf = scale_conf(tb100, cores_total=8000)
    # 10 TB of partial aggregates / 256 MB = 40,960 reducers, capped at 4 x cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 32000
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    mid = scale_conf(1 << 40, cores_total=1000)              # 1 TB: 410 wanted -> 2 x cores
    assert int(mid["spark.sql.shuffle.partitions"]) == 2000
    small = scale_conf(1 << 30, cores_total=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128   # never below 2 x cores


def test_shared_dir_is_below_the_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(base.rstrip("/")) and a != b


def test_no_machine_local_folder_on_a_cluster():
    import pytest

    from shoreline.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
