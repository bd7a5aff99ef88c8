"""Checkpoint folder rule: a cluster must name a shared folder; only local
sessions may fall back to a scratch folder of their own."""
import pytest

from tidewater.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Session:
    """Stands in for a cluster session (no SparkContext in this process)."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session({"spark.master": "yarn"}))


def test_configured_shared_folder_is_used_as_is():
    s = _Session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/shared/ckpt"


def test_local_session_without_setting_gets_a_scratch_folder():
    s = _Session({"spark.master": "local[2]"})
    path = checkpoint_dir(s)
    assert path and s.conf.get("spark.checkpoint.dir") == path
