"""The checkpoint folder: the session's, a private one in local runs, else an error."""

from types import SimpleNamespace

import pytest

from tablestats.session import ensure_checkpoint_dir


def fake(master, folder=None):
    conf, seen = {"spark.checkpoint.dir": folder} if folder else {}, []
    context = SimpleNamespace(master=master, setCheckpointDir=seen.append)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__), sparkContext=context)
    return session, seen


def test_configured_folder_is_used():
    session, seen = fake("yarn", "hdfs:///shared")
    assert ensure_checkpoint_dir(session) == "hdfs:///shared" and seen == ["hdfs:///shared"]


def test_local_runs_get_a_folder_once():
    session, _ = fake("local[4]")
    assert ensure_checkpoint_dir(session) == ensure_checkpoint_dir(session)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_clusters_must_name_one(master):
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake(master)[0])
