from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidegauge.session import checkpoint_root


def test_named_folder_is_used(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(session)
