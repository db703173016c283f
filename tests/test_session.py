from types import SimpleNamespace

import pytest

from lakewarden.session import shared_dir


def session(master, setting=None):
    """A stand-in that knows what ``shared_dir`` asks for."""
    state = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda folder: state.update(dir=folder),
    )
    conf = SimpleNamespace(get=lambda name, default=None: setting or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_used():
    spark = session("spark://host:7077", "hdfs:///shared")
    assert shared_dir(spark) == "hdfs:///shared"
    assert spark.sparkContext.getCheckpointDir() == "hdfs:///shared"


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_dir(session("yarn"))


def test_a_local_session_gets_its_own_once():
    spark = session("local[2]")
    first = shared_dir(spark)
    assert first == shared_dir(spark)
