"""Scratch space comes from spark.checkpoint.dir; never machine-local on a cluster."""

import pytest

from tessera.session import shared_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):
        self.value = value


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, master, conf_value=None):
        self.conf, self.sparkContext = _Conf(conf_value), _Ctx(master)


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "spark://host:7077"])
def test_cluster_without_checkpoint_dir_refuses(master):
    with pytest.raises(RuntimeError):
        shared_dir(_Session(master))


def test_cluster_setting_is_used():
    s = _Session("yarn", "hdfs://shared/ckpt/")
    assert shared_dir(s) == "hdfs://shared/ckpt"
    sub = shared_dir(s, "x")
    assert sub.startswith("hdfs://shared/ckpt/x-") and sub != shared_dir(s, "x")


def test_local_without_setting_gets_scratch():
    s = _Session("local[8]")
    d = shared_dir(s)
    assert d.startswith("/") and s.conf.value == d
