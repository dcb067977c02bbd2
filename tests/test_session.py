"""Stage tables: where they go, and that they go away."""

import os

import pytest

from martcraft import session as S


class Fake:
    """As much of a session as the folder rules read."""

    def __init__(self, master, conf=None, context=None):
        self.master, self.value, self.dir = master, conf, context
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.value or default

    def getCheckpointDir(self):
        return self.dir


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1000]"])
def test_unset_folder_off_a_local_master_raises(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(Fake(master))
    assert S.ensure_checkpoint_dir(Fake(master, "s3://bucket/x")) == "s3://bucket/x"
    assert S.ensure_checkpoint_dir(Fake(master, None, "/shared")) == "/shared"


def test_local_scratch_is_stable_and_sets_nothing():
    for master in ("local", "local[4]", "local[*]"):
        fake = Fake(master)
        a, b = S.ensure_checkpoint_dir(fake), S.ensure_checkpoint_dir(fake)
        assert a == b and os.path.isdir(a)
        assert fake.value is None and fake.dir is None


def test_run_folder_is_removed(spark):
    with S.stage_run(spark) as folder:
        df = S.materialize(spark.range(5), "x")
        assert df.count() == 5 and len(os.listdir(folder)) == 1
    assert not os.path.exists(folder)
    with pytest.raises(ValueError), S.stage_run(spark) as folder:
        S.materialize(spark.range(5))
        raise ValueError
    assert not os.path.exists(folder)


def test_empty_stage_table(spark):
    assert S.materialize(spark.range(5).where("id > 9")).columns == ["id"]
    assert S.materialize(spark.range(0)).count() == 0
