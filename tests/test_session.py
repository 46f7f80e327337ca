from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from quaywork.session import clear_scratch, scratch_path, shared_folder


def test_scratch_folders_are_removed(spark):
    clear_scratch(spark)
    path = scratch_path(spark, "trial")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(local) and clear_scratch(spark) == 1 and not os.path.exists(local)


def test_a_cluster_without_a_shared_folder_is_an_error():
    context = SimpleNamespace(
        master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda *_: None), getCheckpointDir=lambda: None
    )
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        shared_folder(session)


@pytest.mark.parametrize("master", ["local", "local[8]"])
def test_a_local_session_without_a_setting_gets_one_folder(master):
    context = SimpleNamespace(
        master=master,
        applicationId=f"trial-{master}",
        getConf=lambda: SimpleNamespace(get=lambda *_: None),
        getCheckpointDir=lambda: None,
    )
    # Like Spark's, this configuration cannot be changed.
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    folder = shared_folder(session)
    assert os.path.isdir(folder) and shared_folder(session) == folder
    os.rmdir(folder)
