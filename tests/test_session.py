"""Checkpoint folder: read from the session, set only for a bare local session, never local on a cluster."""

import pytest

from ledgerlint import session as S


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class _SC:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _SC(master)


def test_existing_checkpoint_dir_is_used_as_is():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert S.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(ValueError):
        S.ensure_checkpoint_dir(_Session("yarn"))


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    d = S.ensure_checkpoint_dir(s)
    assert d.startswith("/tmp/") and s.conf.get("spark.checkpoint.dir") == d


def test_configure_fills_only_unset_settings():
    s = _Session("local[2]", {"spark.sql.session.timeZone": "Europe/Paris"})
    S.configure(s)
    assert s.conf.get("spark.sql.session.timeZone") == "Europe/Paris"
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
