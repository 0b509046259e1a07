"""Checkpoint-folder rules: the cluster's setting wins; a local run without
one falls back; a cluster without one is refused."""

import pytest

from pricetide.session import ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = "file:" + path.rstrip("/") + "/0000-uuid"


class _Session:
    def __init__(self, conf_value, master, current=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(master, current)


def test_cluster_setting_wins():
    s = _Session("hdfs://nn/shared/ckpt/", "yarn")
    assert ensure_checkpoint_dir(s, "/tmp/ignored") == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.current.startswith("file:hdfs://nn/shared/ckpt")
    assert scratch_path(s, "q").startswith("hdfs://nn/shared/ckpt/pricetide-scratch/q-")


def test_local_run_without_setting_uses_fallback():
    s = _Session(None, "local[4]")
    assert ensure_checkpoint_dir(s, "/tmp/fallback") == "file:/tmp/fallback/0000-uuid"


def test_cluster_without_setting_is_refused():
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_Session(None, "yarn"))


def test_real_session_has_a_folder(spark):
    assert ensure_checkpoint_dir(spark)
