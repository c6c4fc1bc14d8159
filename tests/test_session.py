"""Shared-folder rules: the session's spark.checkpoint.dir, never a private
folder on a cluster."""

import pytest

from logwarden.session import scratch_path, shared_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self.applicationId, self._ckpt = master, "app-1", ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, ckpt)


def test_session_setting_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt"
    p1, p2 = scratch_path(s, "x"), scratch_path(s, "x")
    assert p1.startswith("hdfs://nn/shared/ckpt/logwarden/x-") and p1 != p2


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://master:7077"))


def test_local_session_gets_a_private_folder_once():
    s = _Session("local[2]")
    d = shared_dir(s)
    assert d and shared_dir(s) == d


def test_real_session_uses_its_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
