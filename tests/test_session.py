"""Checkpoint folder rule and real defaults of the operators."""

import pytest

from kitchenlens import session
from kitchenlens.operators import mlprep, neighbourhood


class FakeConf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value

    def set(self, key, value):
        self.value = value


class FakeContext:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getConf(self):
        return FakeConf(None)

    def setCheckpointDir(self, path):
        self.dir = path


class FakeSession:
    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = FakeConf(folder), FakeContext(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(FakeSession(master))
    assert session.ensure_checkpoint_dir(FakeSession(master, "hdfs:///shared")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_a_local_session_gets_a_scratch_folder(master):
    assert "kitchenlens-ckpt-" in session.ensure_checkpoint_dir(FakeSession(master))


def test_real_defaults():
    assert neighbourhood.DEFAULT_CENSUS_SLICES == [(2011, 2012, None, 2006), (2013, 2017, "neigh_pop_2011", 2011), (2018, None, "neigh_pop_2016", 2016)]
    assert neighbourhood.DEFAULT_CRIME_START_YEAR == 2014
    assert mlprep.FOLD_STARTS == ["2018-07-01", "2018-10-01", "2019-01-01", "2019-04-01", "2019-07-01"]
    assert (mlprep.FOLD_TRAIN_START, mlprep.OPERATING_CUTOFF) == ("2017-01-01", "2017-11-01")
    assert mlprep.NUMERIC_FEATURES == ["time_since_last_infrac", "days_since_last_inspection"]


def test_stage_tables_are_deleted(spark):
    import os
    a, b = session.cut_lineage(spark.range(3), "a"), session.cut_lineage(spark.range(4), "b")
    session.drop_stage(a)
    assert not os.path.exists(a.stage_path) and b.count() == 4
    session.release_stages(spark)
    assert not os.path.exists(b.stage_path)
