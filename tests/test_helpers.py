from __future__ import annotations

import pytest

from quire import session
from quire.session import checkpoint_dir, clear_scratch, scratch_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default


class _Context:
    """Stands in for a SparkContext: only what checkpoint_dir reads."""

    def __init__(self, master, conf=None, known=None):
        self.master, self.known, self.applicationId, self._conf = master, known, f"app-{master}-{conf}-{known}", _Conf(conf)

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.known

    def setCheckpointDir(self, path):
        self.known = path


class _Session:
    def __init__(self, **kw):
        self.sparkContext = _Context(**kw)


def test_cluster_needs_a_shared_folder(monkeypatch):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(master="spark://host:7077"))
    assert checkpoint_dir(_Session(master="yarn", conf="hdfs://shared")) == "hdfs://shared"
    # a folder the caller has given to the context counts too
    assert checkpoint_dir(_Session(master="yarn", known="hdfs://own/uuid")) == "hdfs://own/uuid"
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: "/tmp/made")
    local = _Session(master="local[2]")
    assert checkpoint_dir(local) == "/tmp/made" == local.sparkContext.known


def test_scratch_is_cleared(spark):
    before = dict(session._SCRATCH)
    try:
        session._SCRATCH.clear()
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3 and clear_scratch(spark) == 1
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(path)
    finally:
        session._SCRATCH.update(before)
