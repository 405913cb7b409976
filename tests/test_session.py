"""Settings and shared folders."""

import pytest

from tillhouse.session import PARTITION_BYTES, shared_dir, shuffle_partitions


def test_shuffle_partitions():
    assert shuffle_partitions(10) == 200
    assert shuffle_partitions(300 * PARTITION_BYTES + 1) == 301


class Cluster:
    """The parts of a session that `shared_dir` looks at."""

    def __init__(self, folder=None, master="yarn"):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_is_read_from_the_session():
    cluster = Cluster("hdfs:///scratch/")
    path = shared_dir(cluster, "x")
    assert path.startswith("hdfs:///scratch/x-")
    assert shared_dir(cluster, "x") != path
    with pytest.raises(ValueError):
        shared_dir(Cluster(), "x")


def test_local_folder_only_in_local_mode_without_setting():
    assert "/tillhouse-" in shared_dir(Cluster(master="local[2]"), "x")
    assert shared_dir(Cluster("/shared", "local[2]"), "x").startswith("/shared/")
