"""The shared checkpoint folder: read from the session, created only when none is configured."""

from __future__ import annotations

import os

import pytest

from lakeshift.session import ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, configured=None, current=None, master="local[2]"):
        self.conf, self.current, self.master = _Conf(configured), current, master

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self.conf

    def setCheckpointDir(self, path):
        self.current = f"file:{path}/uuid"


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_configured_folder_is_used():
    sc = _Context(configured="/shared/ckpt")
    assert ensure_checkpoint_dir(_Session(sc)) == "file:/shared/ckpt/uuid"


def test_existing_folder_is_kept():
    sc = _Context(configured="/shared/ckpt", current="hdfs://nn/ckpt/abc")
    assert ensure_checkpoint_dir(_Session(sc)) == "hdfs://nn/ckpt/abc"
    assert scratch_path(_Session(sc), "merge").startswith("hdfs://nn/ckpt/abc/lakeshift-stage/merge-")


def test_local_folder_only_when_unset():
    sc = _Context()
    path = ensure_checkpoint_dir(_Session(sc))
    local = path.removeprefix("file:").rsplit("/uuid", 1)[0]
    assert os.path.isdir(local) and "lakeshift-ckpt-" in local


def test_a_cluster_without_a_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(_Context(master=master)))
    assert ensure_checkpoint_dir(_Session(_Context(configured="hdfs://nn/c", master="yarn")))


def test_real_session_has_a_folder(spark):
    assert ensure_checkpoint_dir(spark)
