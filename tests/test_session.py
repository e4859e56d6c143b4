import pytest

from tripcast.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Ctx:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _RuntimeConf:
    def get(self, key):
        raise KeyError(key)


class _Spark:
    def __init__(self, master, conf):
        self.sparkContext = _Ctx(master, conf)
        self.conf = _RuntimeConf()


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Spark("yarn", {}))


def test_configured_checkpoint_dir_is_used():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_master_gets_a_temporary_folder():
    s = _Spark("local[2]", {})
    assert "tripcast-ckpt-" in ensure_checkpoint_dir(s)
