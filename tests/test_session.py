import types

import pytest

from glyphmill import session


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


def _spark(master, setting=None):
    conf = types.SimpleNamespace(get=lambda key, default: setting or default)
    return types.SimpleNamespace(conf=conf, sparkContext=_Context(master))


def test_the_setting_names_the_shared_folder(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(_spark("yarn", "hdfs:/shared/")) == "hdfs:/shared"


def test_only_a_local_run_gets_a_temporary_folder():
    local = _spark("local[2]")
    folder = session.shared_folder(local)
    assert folder.startswith("file:/tmp/glyphmill-") and session.shared_folder(local) == folder
    with pytest.raises(ValueError):
        session.shared_folder(_spark("yarn"))
