"""Scratch paths."""

import pytest

from marquee.session import scratch_dir


class Session:
    """Just the parts of a session that name the shared folder and the master."""

    def __init__(self, folder, master="local[8]"):
        self.folder, self.conf, self.sparkContext, self.master = folder, self, self, master

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_scratch_lies_in_the_shared_folder_and_is_new_each_time():
    first, second = (scratch_dir(Session("s3a://shared/ckpt/", "yarn"), "x") for _ in range(2))
    assert first.startswith("s3a://shared/ckpt/marquee/x-") and first != second


@pytest.mark.parametrize("master", ["local", "local[2]", "local[*]"])
def test_scratch_without_a_shared_folder_is_local_in_local_mode(master):
    assert "/marquee-" in scratch_dir(Session(None, master), "x")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_scratch_needs_a_shared_folder_on_a_cluster(master):
    with pytest.raises(ValueError):
        scratch_dir(Session(None, master), "x")
