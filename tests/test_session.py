"""Checkpoint / scratch folder rules of the session helpers."""

import pytest

from replenix import session


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Ctx(master)
        self.conf = _Conf(conf or {})


def test_cluster_session_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session("yarn"))


def test_checkpoint_dir_is_read_from_the_session():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert session.checkpoint_root(s) == "hdfs://nn/shared/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs://nn/shared/ckpt/replenix-scratch/x-")


def test_local_session_without_one_gets_a_fresh_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    import tempfile
    monkeypatch.setattr(tempfile, "tempdir", None)
    s = _Session("local[2]")
    root = session.checkpoint_root(s)
    assert root.startswith(str(tmp_path)) and s.sparkContext.getCheckpointDir() == root
