"""The shared folder: taken from the session, made up for local masters alone."""

import pytest

from railtrace.session import ensure_checkpoint_dir


class Session:
    """As much of a session as the helper looks at."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext, self.master, self.folder = self, self, master, folder

    def get(self, key, default=None):
        return self.folder or default

    def set(self, key, value):
        self.folder = value

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.checkpoints = folder


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_must_name_the_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session(master))
    named = Session(master, "hdfs://shared/x")
    assert ensure_checkpoint_dir(named) == named.checkpoints == "hdfs://shared/x"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_master_gets_a_scratch_folder(master):
    session = Session(master)
    assert ensure_checkpoint_dir(session) == session.folder == session.checkpoints
